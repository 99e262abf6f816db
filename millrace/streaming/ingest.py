"""Structured Streaming form of ingestion (7.5) and event folding."""

from __future__ import annotations

import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.asof import AsOf
from millrace.operators.dedupe import with_fingerprint
from millrace.operators.events import one_by_one, run_state, source_state
from millrace.operators.normalize import normalize_feed
from millrace.operators.validate import valid_records
from millrace.plans.ingest import analyse_run, close_run, store_batch
from millrace.sinks.tables import Tables
from millrace.sinks.versions import Folder, Versions
from millrace.sources.feeds import TEXT_FORMATS
from millrace.sources.loader import Outcome
from millrace import schemas
from millrace.streaming.fold import KEYED_STATE, keyed_run_state


def stream_feed(spark: SparkSession, path: str, source: str, rank: int, fmt: str = "json", *,
                schema: T.StructType | None = None, position: str | None = None,
                as_of: AsOf = None, options: dict[str, str] | None = None) -> DataFrame:
    """One feed as a stream of canonical rows; the schema is explicit, as streams need.
    Without a ``position`` column rows get their place when their batch is stored."""
    if schema is None:
        schema = (schemas.RAW[source] if fmt in TEXT_FORMATS
                  else spark.read.format(fmt).load(path).schema)
    raw = spark.readStream.options(**(options or {})).schema(schema).format(fmt).load(path)
    place = F.col(position) if position else F.lit(None).cast("bigint")
    return normalize_feed(raw.withColumn("pos", place), source, rank, as_of=as_of)


def drop_recent_duplicates(canonical: DataFrame, delay: str = "1 day") -> DataFrame:
    """D5 for the near past: valid rows whose fingerprint was not seen within the delay.

    The watermark is on arrival time, so late business dates are never dropped.
    For consumers without the record store; ``start_ingest`` compares with the
    whole store instead and keeps the lowest source rank inside a batch.
    """
    return (with_fingerprint(valid_records(canonical)).withWatermark("ingested_at", delay)
            .dropDuplicatesWithinWatermark(["record_hash"]))


def start_ingest(spark: SparkSession, tables: Tables, canonical: DataFrame, checkpoint: str, *,
                 first_run_id: int = 1, trigger: dict | None = None, as_of: AsOf = None,
                 analyse: bool = False) -> StreamingQuery:
    """Ingest a stream of canonical rows; each micro-batch is a run.

    Run id = first id + batch id. A batch that is repeated after a crash gets the
    same id again: its rejects, duplicates and events are replaced, its records are
    already there by fingerprint, and its run row supersedes the earlier one.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        run_id, session = first_run_id + batch_id, batch.sparkSession
        here = tables.in_session(session)
        started, clock = datetime.now(timezone.utc), time.perf_counter()
        placed = batch.withColumn("pos", F.coalesce("pos", F.monotonically_increasing_id()))
        counts, inserted = store_batch(session, here, placed, run_id)
        elapsed = (time.perf_counter() - clock) * 1000
        outcomes = [Outcome(name, "SUCCESS", received, elapsed, None, 1, None)
                    for name, (received, _, _) in sorted(counts.items())]
        close_run(session, here, outcomes, counts, run_id, started, elapsed, inserted, as_of)
        if analyse:
            analyse_run(here, run_id, as_of=as_of)

    return (canonical.writeStream.foreachBatch(process)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def event_stream(spark: SparkSession, tables: Tables) -> DataFrame:
    """E1 live: the events as a stream. The log gets one file per attempt at a run and none is ever
    replaced, so every event of every attempt arrives once; ``attempt`` tells a repeated run's
    events from the earlier ones."""
    Folder(spark, tables.folder("event_log")).ensure()
    log = spark.readStream.schema(schemas.EVENT_LOG).parquet(tables.folder("event_log"))
    return one_by_one(log).select(*schemas.EVENTS.names)


def stream_run_state(events: DataFrame) -> DataFrame:
    """Current state per run; write in update or complete mode."""
    return run_state(events)


def start_run_state(events: DataFrame, folder: str, checkpoint: str, trigger: dict | None = None,
                    silent_after: float | None = None) -> StreamingQuery:
    """Keeps one table with the current state of every run below ``folder``.

    The state of a run is kept by its key (keyed_run_state()); a micro-batch puts the runs that changed in
    place of their old rows and swaps the table as a whole, so readers see one version, and a
    batch that is repeated after a crash changes nothing. Runs without an event for ``silent_after``
    seconds that have not finished are marked silent.
    """
    spark = events.sparkSession
    # State with timers and collections needs this store; it is read when the query starts.
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", KEYED_STATE)

    def keep(batch: DataFrame, batch_id: int) -> None:
        table = Versions(batch.sparkSession, folder)
        # A run may come twice in a batch: from its events and from its timer.
        newest = batch.groupBy("run_id").agg(
            F.max_by(F.struct(*schemas.RUN_STATE.names[1:]), F.col("step")).alias("s")).select("run_id", "s.*")
        # Written before it is used twice: a batch must go through the state store once.
        newest.write.mode("overwrite").parquet(f"{folder}/changed")
        changed = batch.sparkSession.read.schema(schemas.RUN_STATE).parquet(f"{folder}/changed")
        rest = table.read(schemas.RUN_STATE).join(changed.select("run_id"), "run_id", "left_anti")
        table.write(rest.unionByName(changed).coalesce(8))

    return (keyed_run_state(events, silent_after).writeStream.outputMode("update").foreachBatch(keep)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def read_run_state(spark: SparkSession, folder: str) -> DataFrame:
    """Current state of every run that start_run_state() has seen."""
    return Versions(spark, folder).read(schemas.RUN_STATE)


def stream_source_state(events: DataFrame) -> DataFrame:
    """Current state per source; write in update or complete mode."""
    return source_state(events)
