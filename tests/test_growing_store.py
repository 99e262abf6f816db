"""Stores that grow run by run: summaries, compaction, event log, keyed state, snapshots."""

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import forest
from millrace.operators.events import run_state
from millrace.plans.ingest import analyse_run, run_forest, run_ingestion, summarise_values
from millrace.sinks.tables import Tables
from millrace.sinks.versions import Versions
from millrace.sources.feeds import SourceSpec, frame_source
from millrace.streaming import ingest as streaming

AS_OF = "2024-01-31 00:00:00"


def lake(spark, tmp_path, name, **options):
    return Tables(spark, str(tmp_path / name), f"grow_{name}", **options).create()


def batch(spark, first, count, scale=1.0):
    return spark.range(first, first + count).select(
        F.sha2(F.col("id").cast("string"), 256).alias("record_hash"), F.lit("Source A").alias("source"),
        F.concat(F.lit("R-"), "id").alias("record_id"), F.lit("n").alias("name"), F.lit("a@b.cd").alias("email"),
        (F.pmod(F.xxhash64("id"), F.lit(100_000)) * F.lit(scale)).alias("value"),
        F.lit(AS_OF).cast("timestamp").alias("created_at"), F.lit(AS_OF).cast("timestamp").alias("ingested_at"),
        F.lit(1).alias("source_rank"), F.col("id").alias("pos"))


def test_forest_of_three_runs_is_that_of_all_rows(spark, tmp_path):
    tables = lake(spark, tmp_path, "forest", buckets=2)
    for run, (first, count) in enumerate(((0, 30_000), (30_000, 400), (40_000, 9_000)), 1):
        tables.save_records(batch(spark, first, count), run)
        summarise_values(tables, run)
    summarise_values(tables, 2)  # a repeated run changes nothing
    stored = run_forest(tables, 3)
    whole = forest.fit_forest(tables.records(), ("record_hash",))
    assert np.array_equal(stored.borders, whole.borders) and np.array_equal(stored.scores, whole.scores)
    assert stored.threshold == whole.threshold
    # A later run keeps only rows that can be among the smallest hashes of all.
    kept = {r["run_id"]: r["count"] for r in tables.read("forest_samples").groupBy("run_id").count().collect()}
    assert kept[1] == 25_600 and kept[2] < 400 and kept[3] < 9_000


def test_analysis_of_a_run_reads_its_records_only(spark, tmp_path, monkeypatch):
    tables = lake(spark, tmp_path, "scan", buckets=2)
    for run in (1, 2, 3):
        tables.save_records(batch(spark, 1000 * run, 300), run)
        summarise_values(tables, run)
    plans, write = [], Tables.replace_run

    def seen(self, table, rows, run_id):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(self, table, rows, run_id)

    monkeypatch.setattr(Tables, "replace_run", seen)
    found = {}
    monkeypatch.setattr(Tables, "save_anomalies", lambda self, rows: found.update(
        plan=rows._jdf.queryExecution().executedPlan().toString()))
    tables.save_run(spark.createDataFrame([], schemas.RUNS))
    analyse_run(tables, 3, as_of=AS_OF)
    plans.append(found["plan"])
    scans = [line for plan in plans for line in plan.splitlines() if "FileScan" in line and "grow_scan.records[" in line]
    assert scans and all("EqualTo(run_id,3)" in line for line in scans)


def test_value_counts_bins(spark):
    frame = batch(spark, 0, 5_000, 0.37).withColumn("value", F.expr(
        "case when value < 300 then -value when value < 1000 then double('NaN') when value < 2000 then 0 else value end"))
    rows = [r["value"] for r in frame.select("value").collect()]
    rows = [v for v in rows if v == v]
    exact = forest.value_counts(frame).collect()
    assert all(r["low"] == r["high"] for r in exact) and sum(r["rows"] for r in exact) == len(rows)
    assert len(exact) == len(set(rows))
    coarse = forest.value_counts(frame, points=3_000).collect()
    assert len(coarse) <= 3_300 and len(coarse) < len(exact) and sum(r["rows"] for r in coarse) == len(rows)
    for r in coarse:
        assert sum(r["low"] <= v <= r["high"] for v in rows) == r["rows"]
        assert abs(r["high"] - r["low"]) <= max(abs(r["low"]), abs(r["high"])) * 2.0 ** -9


@pytest.mark.parametrize("pieces", [1, 3, 700])
def test_ranges_are_searched_at_any_number(spark, pieces):
    borders = np.arange(0.0, 2.0 * pieces)
    scores = np.array([float(k % 2) for k in range(len(borders) + 1)])
    model = forest.Forest(borders, scores, 0.5)
    values = [-5.0, 0.0, 0.5, 1.0, 1.5, 2.0 * pieces - 1, 2.0 * pieces, 1e300, pieces + 0.25]
    frame = spark.createDataFrame([(v,) for v in values], "value double")
    got = [r[0] for r in frame.select(model.flags("value")).collect()]
    assert got == [model.score(v) > 0.5 for v in values]
    ends = forest.Forest(np.array([1.0]), np.array([1.0, 0.0]), 0.5)
    assert [r[0] for r in frame.select(ends.flags("value")).collect()] == [v <= 1.0 for v in values]
    none = forest.Forest(np.array([1.0]), np.array([0.0, 0.0]), 0.5)
    assert not any(r[0] for r in frame.select(none.flags("value")).collect())


def test_compaction(spark, tmp_path):
    tables = lake(spark, tmp_path, "compact", buckets=3, files_per_bucket=2)
    for run in range(1, 6):
        tables.save_records(batch(spark, 100 * run, 50), run)
    assert max(tables.record_files().values()) == 5
    reader = tables.records()
    assert tables.compact_if_needed() and not tables.compact_if_needed()
    assert tables.record_files() == {0: 1, 1: 1, 2: 1}
    assert reader.count() == tables.records().count() == 250
    # Another opening of the store, and writes after the swap.
    again = Tables(spark, tables.root, tables.database).create()
    assert again.buckets == 3 and again.save_records(batch(spark, 100, 60), 9) == 10
    assert tables.records().count() == 260
    plan = again.records().groupBy("record_hash").count()._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
    old = tables._records_folder()
    assert tables.compact_records() and tables.compact_records()
    assert not os.path.exists(old.removeprefix("file:")) and tables.records().count() == 260


def test_compaction_starts_again_when_a_run_writes_meanwhile(spark, tmp_path, monkeypatch):
    tables = lake(spark, tmp_path, "race", buckets=2)
    for run in (1, 2):
        tables.save_records(batch(spark, 100 * run, 40), run)
    publish, create, begun = Versions.publish, Tables._create, []

    def late(self, table, *rest):
        if table.startswith("records_") and not begun:
            begun.append(table)
            create(self, table, *rest)
            self.save_records(batch(spark, 900, 5), 3)
            return
        create(self, table, *rest)

    monkeypatch.setattr(Tables, "_create", late)
    published = []
    monkeypatch.setattr(Versions, "publish", lambda self, data: (published.append(data), publish(self, data)))
    assert tables.compact_records() and len(published) == 1
    assert tables.records().count() == 85


def scanned(rows):
    """Rows that the scan of a query gave out, of the row groups that it read."""
    rows.collect()
    scan = rows._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return int(scan.metrics().apply("numOutputRows").value())


def test_lookups_skip_row_groups(spark, tmp_path):
    tables = lake(spark, tmp_path, "lookup", buckets=4)
    shape = schemas.ANOMALIES
    for run in range(1, 5):
        rows = spark.range(1000 * run, 1000 * run + 400)
        tables.save_records(batch(spark, 1000 * run, 400), run)
        tables.save_anomalies(rows.select(F.concat(F.lit("anom-"), F.col("id")).alias("id"), F.lit(run).alias("run_id")))
        tables.save_lineage(rows.select(F.concat(F.lit("R-"), F.col("id")).alias("record_id"), F.lit(run).alias("run_id")))
    assert tables.read("anomalies").schema.names == shape.names
    for table, key, value in (("anomalies", "id", "anom-2007"), ("data_lineage", "record_id", "R-3100")):
        found = tables.read(table).filter(F.col(key) == value)
        # Of the files of four runs one row group has the value.
        assert found.count() == 1 and scanned(found) <= 400, table
        assert spark.table(tables.name(table)).count() == 1600
    records = tables.records().filter("record_id = 'R-4010'")
    assert records.count() == 1 and scanned(records) <= 150
    missing = tables.records().filter("record_id = 'R-0'")
    assert missing.count() == 0 and scanned(missing) <= 150


def test_versions(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "table"))
    assert table.read(schemas.RUN_STATE).count() == 0
    for n in (3, 4, 5):
        table.write(spark.range(n))
    assert spark.read.parquet(table.current()).count() == 5
    assert len(table._markers()) == 2 and len(table.folder.matching("data-*")) == 2


class Failing:
    def __init__(self, frame, failures):
        self.frame, self.failures = frame, failures

    def __call__(self, spark):
        if self.failures:
            self.failures -= 1
            # An attempt that has written and then breaks.
            return self.frame.withColumn("id", F.when(F.col("id") > "A-3", F.raise_error(F.lit("broken"))).otherwise(F.col("id")))
        return self.frame


def test_repeated_run_has_one_snapshot_and_no_unused_raw_rows(spark, tmp_path):
    tables = lake(spark, tmp_path, "repeat", buckets=2)
    rows = [(f"A-{k}", "n", f"a{k}@b.cd", str(k), "01-02-2024") for k in range(6)]
    frame = spark.createDataFrame(rows, "id string, name string, email string, amount string, created string")
    flaky = Failing(frame, 1)
    specs = [SourceSpec("Source A", 1, flaky, None), frame_source("Source B", 2, frame.limit(0).selectExpr(
        "id customer_id", "name full_name", "email email_address", "amount value", "created timestamp"))]
    for _ in range(2):
        run_ingestion(spark, tables, specs, run_id=1, as_of=AS_OF, attempts=2, retry_seconds=0.0)
    for name in ("quality_metrics", "pipeline_health"):
        assert tables.read(name).count() == 1, name
    assert tables.read("pipeline_health").first()["run_id"] == 1
    folders = [d for d, _, files in os.walk(tables.raw_root) if any(f.endswith(".parquet") for f in files)]
    used = [r["raw_path"] for r in tables.runs().first()["source_results"]]
    assert sorted(folders) == sorted(used)
    assert spark.table(tables.name("event_log")).count() == 2
    assert {r["attempt"] for r in tables.read("events").collect()} == {2}
    run_ingestion(spark, tables, specs, run_id=2, as_of=AS_OF)
    assert tables.read("quality_metrics").count() == 2 and tables.read("events").count() == 12


def events_of(spark, runs, unfinished=()):
    rows = []
    for run in runs:
        for k, (event, source, records, status) in enumerate((
                ("INGESTION_STARTED", None, None, None), ("SOURCE_STARTED", "S", None, None),
                ("SOURCE_COMPLETED", "S", 5 * run, None), ("SOURCE_FAILED", "Q", None, None),
                ("SOURCE_COMPLETED", "S", 1, None), ("INGESTION_COMPLETED", None, None, "PARTIAL"))):
            if event != "INGESTION_COMPLETED" or run not in unfinished:
                rows.append((event, run, 1_700_000_000 + 60 * run + k // 2, source, records, None, None, status))
    return spark.createDataFrame(rows, "event string, run_id long, t long, source string, records long, "
                                 "duration_ms double, error string, status string").withColumn(
        "timestamp", F.timestamp_seconds("t")).drop("t")


def test_keyed_state_equals_the_fold(spark, tmp_path):
    rows = events_of(spark, range(1, 9), unfinished=(4,))
    rows.repartition(6, F.xxhash64("event", "run_id", "records")).write.parquet(str(tmp_path / "events"))
    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "events"))
    streaming.start_run_state(arriving, str(tmp_path / "state"), str(tmp_path / "checkpoint")).awaitTermination()
    found = streaming.read_run_state(spark, str(tmp_path / "state"))
    want = run_state(rows)
    columns = [c for c in want.columns]
    assert (sorted(map(tuple, found.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect())))
    # One table, two versions of it, whatever the number of batches.
    assert len([n for n in os.listdir(tmp_path / "state") if n.startswith("data-")]) == 2


def test_silent_runs_are_marked(spark, tmp_path):
    rows = events_of(spark, (1, 2), unfinished=(2,))
    rows.write.parquet(str(tmp_path / "events"))
    arriving = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "events"))
    query = streaming.start_run_state(arriving, str(tmp_path / "state"), str(tmp_path / "checkpoint"),
                                      {"processingTime": "1 second"}, silent_after=2.0)
    try:
        for _ in range(60):
            time.sleep(1)
            found = {r["run_id"]: r["silent"] for r in streaming.read_run_state(spark, str(tmp_path / "state")).collect()}
            if found == {1: False, 2: True}:
                break
    finally:
        query.stop()
    assert found == {1: False, 2: True}
