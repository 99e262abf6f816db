"""Loading sources independently of each other.

Every source is its own Spark job, submitted from its own driver thread, that
writes its raw rows to its own folder. Only the outcome comes back to the driver.
"""

from __future__ import annotations

import re
import threading
import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from millrace import contract as K, schemas
from millrace.sources.feeds import SourceSpec

MAX_PARALLEL = 32


@dataclass(frozen=True)
class Outcome:
    """What one source did in a run; the raw rows are in ``raw_path``."""

    source: str
    status: str
    received: int
    duration_ms: float
    error: str | None
    attempts: int
    raw_path: str | None


def raw_folder(root: str, spec: SourceSpec, run_id: int, attempt: int) -> str:
    name = re.sub(r"[^A-Za-z0-9]+", "_", spec.name).strip("_")
    return f"{root}/source={spec.rank:03d}_{name}/run_id={run_id}/attempt={attempt}"


def _write_raw(spark: SparkSession, spec: SourceSpec, folder: str,
               stopped: threading.Event) -> int:
    """One attempt. Counts while writing, so the rows are read once."""
    if spec.stored:
        return spark.read.parquet(spec.stored).count()
    rows = spec.raw(spark)
    if stopped.is_set():
        raise TimeoutError
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("received")).write.mode("overwrite").parquet(folder)
    return int(seen.get["received"])


def _attempt(spark: SparkSession, spec: SourceSpec, folder: str, timeout: float | None) -> int:
    """One attempt with a time limit, or none. The jobs of an attempt that runs out of time
    are cancelled by their tag; its folder is never read, so a late write is harmless."""
    tag = f"millrace-{uuid.uuid4().hex}"
    stopped, result = threading.Event(), {}

    def work() -> None:
        spark.sparkContext.addJobTag(tag)
        # Running tasks are interrupted too, not only their job given up.
        spark.sparkContext.setLocalProperty("spark.job.interruptOnCancel", "true")
        try:
            result["rows"] = _write_raw(spark, spec, folder, stopped)
        except BaseException as error:  # noqa: BLE001 - reported by the caller
            result["error"] = error
        finally:
            spark.sparkContext.removeJobTag(tag)

    thread = threading.Thread(target=inheritable_thread_target(spark)(work), daemon=True)
    thread.start()
    thread.join(timeout)
    if thread.is_alive():
        stopped.set()
        spark.sparkContext.cancelJobsWithTag(tag)
        raise TimeoutError
    if "error" in result:
        raise result["error"]
    return result["rows"]


def load_source(spark: SparkSession, spec: SourceSpec, run_id: int, raw_root: str, *,
                timeout: float | None = None, attempts: int = K.LOAD_ATTEMPTS,
                retry_seconds: float = K.LOAD_RETRY_SECONDS) -> Outcome:
    """Load one source; never raises. ``attempts`` counts the first try, the
    delay between tries is constant and the time limit holds for each try; without one a load may take as long as it needs."""
    started = time.perf_counter()
    status, error, tried = "FAILED", None, 0
    for tried in range(1, max(1, attempts) + 1):
        folder = spec.stored or raw_folder(raw_root, spec, run_id, tried)
        try:
            received = _attempt(spark, spec, folder, timeout)
            elapsed = (time.perf_counter() - started) * 1000
            return Outcome(spec.name, "SUCCESS", received, elapsed, None, tried, folder)
        except TimeoutError as problem:
            status, error = "TIMEOUT", str(problem) or f"Timed out after {timeout}s"
        except Exception as problem:  # noqa: BLE001 - one source never stops the others
            status, error = "FAILED", str(problem)
        if tried < attempts:
            time.sleep(retry_seconds)
    elapsed = (time.perf_counter() - started) * 1000
    return Outcome(spec.name, status, 0, elapsed, error, tried, None)


def load_sources(spark: SparkSession, specs: Sequence[SourceSpec], run_id: int, raw_root: str, *,
                 timeout: float | None = None, attempts: int = K.LOAD_ATTEMPTS,
                 retry_seconds: float = K.LOAD_RETRY_SECONDS,
                 on_event: Callable[[str, SourceSpec, Outcome | None], None] | None = None,
                 ) -> list[Outcome]:
    """Load all sources at the same time; outcomes in source order."""

    def one(spec: SourceSpec) -> Outcome:
        if on_event:
            on_event("SOURCE_STARTED", spec, None)
        outcome = load_source(spark, spec, run_id, raw_root, timeout=timeout, attempts=attempts,
                              retry_seconds=retry_seconds)
        if on_event:
            on_event("SOURCE_COMPLETED" if outcome.status == "SUCCESS" else "SOURCE_FAILED",
                     spec, outcome)
        return outcome

    if not specs:
        return []
    with ThreadPoolExecutor(max_workers=min(len(specs), MAX_PARALLEL)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(one), specs))


def outcome_frame(spark: SparkSession, outcomes: Sequence[Outcome], run_id: int) -> DataFrame:
    """Outcomes of a run, one row per source."""
    rows = [tuple(asdict(o)[f] for f in schemas.SOURCE_RESULT.names) for o in outcomes]
    return spark.createDataFrame(rows, schemas.SOURCE_RESULT).withColumn(
        "run_id", F.lit(run_id).cast("bigint"))


def read_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Raw rows of one committed load."""
    return spark.read.parquet(folder)
