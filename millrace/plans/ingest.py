"""A whole run: load, normalise, validate, dedupe, store, analyse (all of section S-X)."""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from millrace import contract as K, schemas
from millrace.functions.asof import AsOf, as_instant
from millrace.functions.rules import passes_all
from millrace.operators.alerts import scan_alerts
from millrace.operators.anomaly import run_anomalies, value_anomalies
from millrace.operators.counters import run_counters, value_stats_of
from millrace.operators.dedupe import duplicate_report, with_fingerprint
from millrace.operators.events import event_lists
from millrace.operators.forest import Forest, bottom_sample, fit_stored, value_counts
from millrace.operators.health import pipeline_health
from millrace.operators.lineage import lineage_with_fallback, nest_lineage
from millrace.operators.normalize import union_feeds
from millrace.operators.quality import quality_snapshot, snapshot_of
from millrace.operators.reads import by_id, latest_snapshot, page_counts
from millrace.operators.validate import rejected_records
from millrace.sinks.tables import Tables
from millrace.sources.feeds import SourceSpec, stored_source
from millrace.sources.loader import Outcome, load_sources, outcome_frame, read_raw


def source_summary(canonical: DataFrame) -> DataFrame:
    """Received, rejected, valid and unique rows of every source in one plan.

    Rows are first counted per source and fingerprint (combined before the
    shuffle); what is ordered per fingerprint is one row per source. Rejected rows
    have no fingerprint here and are one row per source too.
    """
    ok = passes_all()
    counted = (with_fingerprint(canonical)
               .groupBy("source", "source_rank",
                        F.when(ok, F.col("record_hash")).alias("record_hash"))
               .agg(F.count(F.lit(1)).alias("rows"), F.min("pos").alias("pos")))
    place = F.row_number().over(W.partitionBy("record_hash").orderBy("source_rank", "pos"))
    good = F.col("record_hash").isNotNull()
    return (counted.withColumn("place", place).groupBy("source").agg(
        F.sum("rows").alias("received"),
        F.coalesce(F.sum(F.when(~good, F.col("rows"))), F.lit(0)).alias("rejected"),
        F.count_if(good & (F.col("place") == 1)).alias("unique_records"))
        .withColumn("valid", F.col("received") - F.col("rejected"))
        .withColumn("duplicates", F.col("valid") - F.col("unique_records"))
        .select("source", "received", "rejected", "valid", "unique_records", "duplicates"))


def run_ingestion(spark: SparkSession, tables: Tables, specs: Sequence[SourceSpec], *,
                  run_id: int | None = None, as_of: AsOf = None,
                  timeout: float | None = None, attempts: int = K.LOAD_ATTEMPTS,
                  retry_seconds: float = K.LOAD_RETRY_SECONDS, forest: bool = True) -> DataFrame:
    """One run; returns its row of ``ingestion_runs``.

    Data is written first and the run row last: readers that start from run rows
    never see an unfinished run, and repeating a run that broke off inserts nothing
    twice because records are matched by fingerprint.
    """
    run_id = tables.next_run_id() if run_id is None else run_id
    started, clock = datetime.now(timezone.utc), time.perf_counter()
    outcomes = load_sources(spark, specs, run_id, tables.raw_root, timeout=timeout,
                            attempts=attempts, retry_seconds=retry_seconds)
    duration_ms = (time.perf_counter() - clock) * 1000
    feeds = [spec.canonical(read_raw(spark, o.raw_path), as_of)
             for spec, o in zip(specs, outcomes) if o.status == "SUCCESS"]
    counts, inserted = {}, 0
    if feeds:
        counts, inserted = store_batch(spark, tables, union_feeds(feeds), run_id,
                                       {s.rank: s.name for s in specs})
    close_run(spark, tables, outcomes, counts, run_id, started, duration_ms, inserted, as_of)
    analyse_run(tables, run_id, as_of=as_of, forest=forest)
    tables.compact_if_needed()
    return tables.runs().filter(F.col("run_id") == run_id)


def store_batch(spark: SparkSession, tables: Tables, canonical: DataFrame, run_id: int,
                names: dict[int, str] | None = None) -> tuple[dict[str, tuple[int, int, int]], int]:
    """Records, rejects and duplicates of one batch.

    Fingerprinted rows are written once, split by validity; everything after reads
    that folder, and a lost executor costs only the tasks it ran. Repeating a batch
    under the same run id replaces its rows. Returns (received, valid, kept) per source
    of the run (by rank: a mixed source is one, whatever schemas its rows have) and the
    number of records that this run added to the store, in this attempt or an earlier one.
    """
    folder = f"{tables.root}/staged/run_id={run_id}"
    (with_fingerprint(canonical).withColumn("valid", passes_all())
     .write.mode("overwrite").partitionBy("valid").parquet(folder))
    shape = with_fingerprint(canonical).schema.add("valid", "boolean")
    staged = spark.read.schema(shape).parquet(folder)
    valid = staged.filter("valid").drop("valid")
    tables.replace_run("rejects", rejected_records(staged.filter("not valid")), run_id)
    tables.replace_run("duplicates", duplicate_report(valid), run_id)
    tables.save_records(valid, run_id)
    inserted = tables.read("records").filter(F.col("run_id") == run_id).count()
    received = staged.groupBy("source_rank").agg(
        F.count(F.lit(1)).alias("received"), F.count_if("valid").alias("valid"),
        F.min("source").alias("source"))
    # The source of the lowest rank keeps the record.
    kept = (valid.groupBy("record_hash").agg(F.min("source_rank").alias("source_rank"))
            .groupBy("source_rank").agg(F.count(F.lit(1)).alias("kept")))
    # One row per source of the run.
    counts = {(names or {}).get(r["source_rank"], r["source"]):
              (r["received"], r["valid"], r["kept"] or 0)
              for r in received.join(kept, "source_rank", "left").collect()}
    tables.drop_staged(run_id)
    return counts, inserted


def close_run(spark: SparkSession, tables: Tables, outcomes: Sequence[Outcome],
              counts: dict[str, tuple[int, int, int]], run_id: int, started: datetime,
              duration_ms: float, inserted: int, as_of: AsOf = None) -> None:
    """Source status, then the run row, then the events; raw rows of failed
    attempts go last. Only one row per source is on the driver."""
    run = _run_row(spark, outcomes, counts, run_id, started, duration_ms, inserted)
    tables.save_source_status(_status_rows(outcome_frame(spark, outcomes, run_id), counts, as_of))
    tables.save_run(run)
    tables.log_events(event_lists(run), run_id)
    tables.drop_unused_raw(run_id, [o.raw_path for o in outcomes if o.raw_path])


def _run_row(spark: SparkSession, outcomes: Sequence[Outcome],
             counts: dict[str, tuple[int, int, int]], run_id: int, started: datetime,
             duration_ms: float, inserted: int) -> DataFrame:
    """The run row."""
    valid = sum(v for _, v, _ in counts.values())
    processed = sum(k for _, _, k in counts.values())
    bad = [o.source for o in outcomes if o.status != "SUCCESS"]
    status = "COMPLETED" if not bad else "FAILED" if len(bad) == len(outcomes) else "PARTIAL"
    results = [(o.source, o.status, o.received, o.duration_ms, o.error, o.attempts, o.raw_path)
               for o in outcomes]
    row = (run_id, status, sum(o.received for o in outcomes), processed, valid - processed,
           len(bad), duration_ms, started, datetime.now(timezone.utc), results, bad, inserted)
    return spark.createDataFrame([row], schemas.RUNS)


def _status_rows(outcomes: DataFrame, counts: dict[str, tuple[int, int, int]],
                 as_of: AsOf) -> DataFrame:
    """A3: every source with what was kept of its rows."""
    at, ok = as_instant(as_of), F.col("status") == "SUCCESS"
    kept = {name: c[2] for name, c in counts.items()}
    twice = {name: c[1] - c[2] for name, c in counts.items()}

    def per_source(numbers: dict[str, int]):
        pairs = [F.lit(x) for item in numbers.items() for x in item]
        found = F.try_element_at(F.create_map(*pairs), "source") if pairs else F.lit(None)
        return F.coalesce(found, F.lit(0)).cast("bigint")

    return outcomes.select(
        "source", F.when(ok, "HEALTHY").otherwise("DEGRADED").alias("status"),
        F.when(ok, at).alias("last_success"), F.when(~ok, at).alias("last_failure"),
        F.col("received").alias("records_received"), per_source(kept).alias("records_processed"),
        per_source(twice).alias("duplicates"), F.col("error").alias("error_message"),
        "run_id", at.alias("updated_at"))


def analyse_run(tables: Tables, run_id: int, *, as_of: AsOf = None, forest: bool = True) -> None:
    """Quality, anomalies, health and alerts after a run.

    Scanned for anomalies are the records of this run, with all earlier ones as their
    history; a first run is its own history. Scores, statistics and the forest come from the
    counters, samples and value counts that each run leaves: no record of an earlier run is
    read.
    """
    scan = tables.records().filter(F.col("run_id") == run_id)
    tables.replace_run("run_counters", run_counters(scan), run_id)
    tables.replace_run("page_counts", page_counts(scan), run_id)
    counters = tables.read("run_counters")
    tables.save_quality(snapshot_of(counters, None, run_id, as_of))
    earlier = not counters.filter(F.col("run_id") < run_id).isEmpty()
    stats = value_stats_of(counters.filter(F.col("run_id") <= run_id), not earlier)
    found = value_anomalies(scan, run_id=run_id, as_of=as_of, stats=stats,
                            forest=run_forest(tables, run_id) if forest else None)
    runs = tables.runs()
    tables.save_anomalies(found.unionByName(run_anomalies(runs, as_of=as_of)))
    tables.save_health(pipeline_health(runs, tables.sources(), tables.anomalies(), as_of), run_id)
    tables.save_alerts(scan_alerts(tables.sources(), runs, tables.anomalies(), as_of=as_of))


def summarise_values(tables: Tables, run_id: int) -> None:
    """M5: what a run adds to the training of later forests: its rows among the sample of all runs
    so far, and how often its values occur."""
    scan = tables.records().filter(F.col("run_id") == run_id)
    earlier = tables.read("forest_samples").filter(F.col("run_id") < run_id)
    tables.replace_run("forest_samples", bottom_sample(scan, ("record_hash",), beside=earlier), run_id)
    tables.replace_run("value_counts", value_counts(scan), run_id)


def run_forest(tables: Tables, run_id: int) -> Forest | None:
    """The forest of all values up to a run, from what the runs have left."""
    summarise_values(tables, run_id)
    known = F.col("run_id") <= run_id
    return fit_stored(tables.read("forest_samples").filter(known), tables.read("value_counts").filter(known))


def rebuild_counters(tables: Tables) -> None:
    """Counters, samples and value counts of every stored run, for a store that was filled
    without them."""
    for row in tables.runs().select("run_id").orderBy("run_id").toLocalIterator():
        scan = tables.records().filter(F.col("run_id") == row["run_id"])
        tables.replace_run("run_counters", run_counters(scan), row["run_id"])
        tables.replace_run("page_counts", page_counts(scan), row["run_id"])
        summarise_values(tables, row["run_id"])


def replay_run(spark: SparkSession, tables: Tables, run_id: int, source: str | None = None, *,
               specs: Sequence[SourceSpec] = (), as_of: AsOf = None, forest: bool = True,
               timeout: float | None = None) -> tuple[DataFrame, str]:
    """An earlier run again under a new run id, all its sources or one.

    Sources that had loaded are replayed from their raw rows, where these lie; sources that had
    failed are read again when ``specs`` has them. ``specs`` also brings the
    normalisers of sources that are not built in. Returns the new run's row and a
    message; an unknown run raises ValueError.
    """
    old = tables.runs().filter(F.col("run_id") == run_id).select("source_results").first()
    if old is None:
        raise ValueError(f"run {run_id} not found")
    given = {s.name: s for s in specs}
    again = []
    for place, result in enumerate(old["source_results"]):
        name, spec = result["source"], given.get(result["source"])
        if source and name != source:
            continue
        if result["status"] == "SUCCESS":
            again.append(stored_source(name, spec.rank if spec else place + 1, result["raw_path"],
                                       spec.normalize if spec else None))
        elif spec is not None:
            again.append(spec)
    new_id = tables.next_run_id()
    run = run_ingestion(spark, tables, again, run_id=new_id, as_of=as_of, forest=forest,
                        timeout=timeout)
    processed = run.first()["total_processed"]
    message = (f"Run #{run_id} replayed as new Run #{new_id}. "
               f"Processed {processed} unique records.")
    if source:
        message += f" Target source filter: {source}."
    return run, message


def quality_or_compute(tables: Tables, as_of: AsOf = None) -> DataFrame:
    """Latest quality snapshot; the first read computes and stores one."""
    if tables.read("quality_metrics").isEmpty():
        tables.save_quality(quality_snapshot(tables.records(), None, as_of))
    return latest_snapshot(tables.read("quality_metrics"))


def health_or_compute(tables: Tables, as_of: AsOf = None) -> DataFrame:
    """Latest health snapshot; the first read computes and stores one."""
    if tables.read("pipeline_health").isEmpty():
        tables.save_health(pipeline_health(tables.runs(), tables.sources(),
                                           tables.anomalies(), as_of))
    return latest_snapshot(tables.read("pipeline_health"), "updated_at")


def lineage_of(tables: Tables, record_id: str | None = None) -> DataFrame:
    """Lineage of one record id or of all, nested; what is not stored yet is rebuilt
    from the records and stored. An unknown id gives no rows."""
    _, rebuilt = lineage_with_fallback(tables.read("data_lineage"), tables.records(), record_id)
    tables.save_lineage(rebuilt)
    return nest_lineage(by_id(tables.read("data_lineage"), record_id, "record_id")
                        if record_id is not None else tables.read("data_lineage"))
