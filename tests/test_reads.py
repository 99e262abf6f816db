"""Paged and point reads, lineage, events."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import dedupe, events, lineage, reads, upsert

START = datetime(2026, 9, 1)


def stored(spark, n=25):
    """10 rows of A, 8 of B, 7 of C; every two rows arrive together."""
    rows = [(f"r{i}", f"h{i:02d}", "A" if i < 10 else "B" if i < 18 else "C",
             START, START + timedelta(minutes=i // 2)) for i in range(n)]
    return spark.createDataFrame(rows, "record_id string, record_hash string, source string, "
                                 "created_at timestamp, ingested_at timestamp").repartition(4)


def ids(frame):
    return [r["record_hash"] for r in frame.collect()]


def test_pages(spark):
    rows = stored(spark)
    pages = [ids(reads.records_page(rows, p, 10)) for p in (1, 2, 3, 4)]
    assert [len(p) for p in pages] == [10, 10, 5, 0]
    assert sum(pages, []) == [f"h{i:02d}" for i in reversed(range(25))]
    assert ids(reads.records_page(rows, 0, 0)) == ["h24"]
    last = reads.records_page(rows, 10, 1).select(*reads.NEWEST).first()
    assert ids(reads.records_after(rows, last, 10)) == pages[1]
    assert len(ids(reads.records_page(rows, 1, 20, "B"))) == 8
    assert tuple(reads.page_numbers(reads.records_total(rows), 3, 10).first()) == (
        3, 10, 25, 3, 21, 25)
    empty = reads.page_numbers(reads.records_total(rows, "none")).first()
    assert (empty["total_pages"], empty["range_end"]) == (1, 0)


def test_trend_and_series(spark):
    rows = [(None if i % 2 else i, float(i), START + timedelta(days=i)) for i in range(1, 31)]
    snaps = spark.createDataFrame(rows, "run_id long, overall_score double, timestamp timestamp")
    for c in ("completeness", "validity", "consistency", "uniqueness", "freshness"):
        snaps = snaps.withColumn(c, F.lit(1.0))
    trend = reads.quality_trend(snaps, 4).collect()
    assert [(r["run_id"], r["overall_score"]) for r in trend] == [
        (1, 27.0), (28, 28.0), (3, 29.0), (30, 30.0)]
    assert reads.quality_trend(snaps, 1000).count() == 30
    assert reads.latest_snapshot(snaps).first()["overall_score"] == 30.0
    runs = spark.createDataFrame([(i, i + 0.5, "COMPLETED") for i in range(1, 15)],
                                 "run_id long, duration_ms double, status string")
    series = reads.duration_series(runs).collect()
    assert [(r["label"], r["duration_ms"]) for r in series] == [
        (f"Run {i}", i + 1) for i in range(5, 15)]
    assert [r["run_id"] for r in reads.recent_runs(runs, 2).collect()] == [14, 13]
    assert reads.by_id(runs, 99, "run_id").count() == 0
    lanes = reads.source_lanes(reads.default_lanes(runs), spark.createDataFrame(
        [("Source B", "DOWN")], "source string, status string"))
    assert {r["name"]: r["health"] for r in lanes.collect()} == {
        "Source A": "UNKNOWN", "Source B": "DOWN", "Source C": "UNKNOWN"}


def test_lineage(spark):
    rows = stored(spark, 3)
    steps = lineage.lineage_steps(rows)
    nested = lineage.nest_lineage(steps).orderBy("record_id").collect()
    assert len(nested) == 3
    assert [s["stage"] for s in nested[0]["steps"]] == [
        "SOURCE", "RAW_INGESTION", "VALIDATION", "NORMALIZATION", "DEDUPLICATION", "STORAGE"]
    assert nested[0]["final_status"] == "STORED" and nested[0]["received_at"] == START
    assert nested[0]["steps"][4]["details"] == {"fingerprint_hash": "h00"}
    every, rebuilt = lineage.lineage_with_fallback(steps.filter("record_id = 'r1'"), rows)
    assert (every.count(), rebuilt.count()) == (18, 12)
    one, fresh = lineage.lineage_with_fallback(steps.limit(0), rows, "r2")
    assert (one.count(), fresh.count()) == (6, 6)
    assert lineage.lineage_with_fallback(steps, rows, "none")[0].count() == 0
    assert lineage.lineage_summary(steps).filter("step_count = 6").count() == 3


def test_run_lineage(spark):
    import golden
    rows = dedupe.with_fingerprint(golden.canonical(spark))
    from millrace.operators.validate import valid_records
    steps = lineage.run_lineage(rows, dedupe.first_occurrences(valid_records(rows)))
    last = {(r["stage"], r["status"]): r["count"]
            for r in steps.groupBy("stage", "status").count().collect()}
    assert last["VALIDATION", "FAILED"] == 1 and last["DEDUPLICATION", "DUPLICATE"] == 8
    assert last["DEDUPLICATION", "SKIPPED"] == 1 and last["STORAGE", "SUCCESS"] == 22
    assert last["STORAGE", "SKIPPED"] == 9 and last["SOURCE", "SUCCESS"] == 31


def test_upsert(spark):
    schema = "run_id long, status string, n long, at long"
    old = spark.createDataFrame([(1, "COMPLETED", 5, 1), (2, "RUNNING", 0, 1)], schema)
    new = spark.createDataFrame([(2, "COMPLETED", 50, 1), (3, "RUNNING", None, 1)], schema)
    rows = {r["run_id"]: (r["status"], r["n"])
            for r in upsert.upsert(old, new, ["run_id"], ["at"]).collect()}
    assert rows == {1: ("COMPLETED", 5), 2: ("COMPLETED", 50), 3: ("RUNNING", None)}


def run_row(spark, results, status):
    row = (1, status, 0, 0, 0, 0, 1500.0, START, START + timedelta(seconds=2),
           [(s, st, n, ms, err, 1, None) for s, st, n, ms, err in results], [], 0)
    return spark.createDataFrame([row], schemas.RUNS)


def test_events(spark):
    run = run_row(spark, [("A", "SUCCESS", 11, 1000.0, None), ("B", "TIMEOUT", 0, 500.0, "late")],
                  "PARTIAL")
    rows = events.lifecycle_events(run).orderBy("seq").collect()
    assert [(r["event"], r["source"]) for r in rows] == [
        ("INGESTION_STARTED", None), ("SOURCE_STARTED", "A"), ("SOURCE_STARTED", "B"),
        ("SOURCE_FAILED", "B"), ("SOURCE_COMPLETED", "A"), ("INGESTION_COMPLETED", None)]
    told = events.activity_feed(events.lifecycle_events(run)).collect()
    assert [(r["message"], r["tone"]) for r in told] == [
        ("Run #1 finished — PARTIAL", "success"), ("A completed — 11 records", "success"),
        ("B failed — late", "error"), ("B started", "info"), ("A started", "info"),
        ("Run #1 started", "info")]
    text = events.event_json(events.lifecycle_events(run)).filter("event = 'SOURCE_FAILED'").first()
    assert text["message"] == ('{"event":"SOURCE_FAILED","run_id":1,"timestamp":'
                               '"2026-09-01T00:00:00.500000+00:00","source":"B",'
                               '"duration_ms":500.0,"error":"late"}')
    state = events.run_state(events.lifecycle_events(run)).first()
    assert (state["last_event"], state["status"], state["sources_failed"], state["records"]) == (
        "INGESTION_COMPLETED", "PARTIAL", 1, 11)
    assert events.lifecycle_events(run_row(spark, [], "COMPLETED")).count() == 2
    failed = events.activity_feed(events.lifecycle_events(run_row(spark, [], "FAILED"))).collect()
    assert failed[0]["tone"] == "error"


@pytest.mark.parametrize("source", [None, "S1"])
def test_pages_by_fence_posts(spark, source):
    # One crowded instant, a crowded minute of several, and hours with little.
    rows = spark.range(6_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("record_hash"), F.concat(F.lit("S"), F.col("id") % 3).alias("source"),
        F.timestamp_seconds(F.expr("""1700000000 + case when id < 2000 then 86400 * 3 when id < 4000 then 7200 + id % 40
            else (id % 500) * 977 end""")).alias("ingested_at")).cache()
    parts = [reads.page_counts(rows.filter(F.pmod(F.xxhash64("record_hash"), F.lit(2)) == k), 300)
             for k in range(2)]
    counts = parts[0].unionByName(parts[1]).cache()
    assert counts.filter("digits is not null").count() > 200
    total = reads.records_total(rows, source).first()[0]
    assert counts.filter(F.lit(source is None) | (F.col("source") == source)).agg(F.sum("rows")).first()[0] == total
    for page, size in ((1, 20), (3, 7), (40, 20), (90, 20), (2, 1900), (total // 50, 50), (total // 50 + 1, 50), (10_000, 20)):
        want = [tuple(r) for r in reads.records_page(rows, page, size, source).collect()]
        found = reads.records_page_at(rows, counts, page, size, source)
        assert [tuple(r) for r in found.collect()] == want, (page, size)
    # A page inside the crowded instant sorts a small part of it.
    deep = reads.records_page_at(rows, counts, 120, 10)
    plan = deep._jdf.queryExecution().optimizedPlan().toString()
    assert "record_hash" in plan.split("Filter", 1)[1].splitlines()[0]
    assert reads.records_page_at(rows.limit(0), counts.limit(0), 1, 20).count() == 0
