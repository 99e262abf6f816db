"""Loading with isolation, tables, streaming."""

import json
import threading
import time

import golden
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.dedupe import with_fingerprint
from millrace.operators.events import lifecycle_events
from millrace.operators.validate import valid_records
from millrace.plans.ingest import (health_or_compute, lineage_of, quality_or_compute, replay_run,
                                   run_ingestion)
from millrace.sinks.tables import Tables
from millrace.sources.feeds import (SourceSpec, file_source, frame_source, payload_source,
                                    read_feed)
from millrace.sources.loader import load_source, load_sources
from millrace.streaming import ingest as streaming


def ok(spark, name, rank, rows=3):
    return frame_source(name, rank, spark.range(rows).withColumnRenamed("id", "seq"), "seq")


def broken(times, then):
    calls = []

    def read(spark):
        calls.append(1)
        if len(calls) <= times:
            raise RuntimeError("upstream outage")
        return then
    return read, calls


def test_isolation_and_timeout(spark, tmp_path):
    def hang(session):
        time.sleep(8)
        return session.range(1)

    specs = [ok(spark, "A", 1), SourceSpec("B", 2, hang), ok(spark, "C", 3, 5)]
    load_source(spark, specs[0], 0, str(tmp_path))
    seen = []
    got = load_sources(spark, specs, 1, str(tmp_path), timeout=6.0, attempts=1,
                       on_event=lambda e, s, o: seen.append((e, s.name)))
    assert [(o.source, o.status, o.received) for o in got] == [
        ("A", "SUCCESS", 3), ("B", "TIMEOUT", 0), ("C", "SUCCESS", 5)]
    assert got[1].error == "Timed out after 6.0s" and got[1].duration_ms >= 6000
    assert ("SOURCE_FAILED", "B") in seen and len(seen) == 6


def test_spark_work_is_cancelled(spark, tmp_path):
    rows = spark.range(0, 4, 1, 4).withColumnRenamed("id", "seq")

    def wait(batches):
        time.sleep(30)
        yield from batches

    spec = frame_source("S", 1, rows.mapInPandas(wait, "seq long"), "seq")
    started = time.time()
    out = load_source(spark, spec, 1, str(tmp_path), timeout=3.0, attempts=1)
    assert out.status == "TIMEOUT" and time.time() - started < 15
    tracker = spark.sparkContext.statusTracker()
    while tracker.getActiveStageIds() and time.time() - started < 15:
        time.sleep(0.2)
    assert time.time() - started < 15


def test_retry(spark, tmp_path):
    read, calls = broken(2, spark.range(4))
    out = load_source(spark, SourceSpec("A", 1, read), 1, str(tmp_path), timeout=60.0,
                      retry_seconds=0.01)
    assert (out.status, out.attempts, out.received, len(calls)) == ("SUCCESS", 3, 4, 3)
    read, calls = broken(9, None)
    out = load_source(spark, SourceSpec("A", 1, read), 2, str(tmp_path), retry_seconds=0.01)
    assert (out.status, out.error, len(calls)) == ("FAILED", "upstream outage", 3)
    assert load_sources(spark, [], 1, str(tmp_path)) == []


def test_sources_load_at_the_same_time(spark, tmp_path):
    meet = threading.Barrier(3, timeout=30)

    def read(session):
        meet.wait()
        return session.range(1)

    got = load_sources(spark, [SourceSpec(n, i, read) for i, n in enumerate("ABC")], 1,
                       str(tmp_path), timeout=60.0, attempts=1)
    assert [o.status for o in got] == ["SUCCESS"] * 3


def write_lines(path, rows):
    path.write_text("\n".join(rows) + "\n")
    return str(path)


def feed_files(folder):
    """The golden feeds as JSON lines, one folder each."""
    out = {}
    for name, rows in (("Source A", golden.FEED_A), ("Source B", golden.FEED_B),
                       ("Source C", golden.FEED_C)):
        where = folder / name.replace(" ", "_")
        where.mkdir()
        names = schemas.RAW[name].names
        write_lines(where / "part.json", [json.dumps(dict(zip(names, r))) for r in rows])
        out[name] = str(where)
    return out


def test_files(spark, tmp_path):
    csv = write_lines(tmp_path / "a.csv", ["id,name,email,amount,created", "1,x,a@b.c,5,22-09-2026"])
    assert file_source("Source A", 1, csv, "csv").raw(spark).first()["amount"] == "5"
    bad = write_lines(tmp_path / "b.json", ['{"customer_id": "1", "value": 2}', '{"customer_id":'])
    rows = read_feed(spark, bad, "json", schemas.RAW_B).collect()
    assert sorted(r["_corrupt_record"] is None for r in rows) == [False, True]
    mixed = payload_source("Mixed", 4, write_lines(tmp_path / "m.txt", [
        '{"userId": "u", "transaction_value": 1}', '{"other": 1}']))
    got = mixed.canonical(mixed.raw(spark), "2026-09-23").collect()
    assert sorted(r["source"] for r in got) == ["Source C", "Unknown"]
    parquet = str(tmp_path / "p")
    spark.createDataFrame([("c", "n", "m@x.y", 1.0, "2026-09-22")], schemas.RAW_B).write.parquet(
        parquet)
    spec = file_source("Source B", 2, parquet, "parquet")
    assert spec.canonical(spec.raw(spark), "2026-09-23").first()["record_id"] == "c"


def test_partial_run_and_recovery(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), "partial", buckets=4).create()
    a, b, c = golden.specs(spark)
    read, _ = broken(1, b.read(spark))
    flaky = SourceSpec("Source B", 2, read, "seq")
    run = run_ingestion(spark, tables, [a, flaky, c], attempts=1, timeout=120.0,
                        as_of="2026-09-23 00:00:00", forest=False).first()
    assert (run["status"], run["total_received"], run["total_failed"], run["failed_sources"]) == (
        "PARTIAL", 21, 1, ["Source B"])
    state = {r["source"]: r for r in tables.sources().collect()}
    assert state["Source B"]["status"] == "DEGRADED"
    assert state["Source B"]["error_message"] == "upstream outage"
    titles = {r["title"] for r in tables.alerts().collect()}
    assert {"Source Degradation: Source B", "Failed Sources in Run #1"} <= titles
    fixed, _ = replay_run(spark, tables, 1, "Source B", specs=[a, flaky, c], forest=False,
                          as_of="2026-09-24 00:00:00")
    row = fixed.first()
    assert (row["status"], row["total_received"], row["total_inserted"]) == ("COMPLETED", 10, 4)
    now = {r["source"]: r for r in tables.sources().collect()}["Source B"]
    assert now["status"] == "HEALTHY" and now["last_failure"] and now["last_success"]
    strict = {r["source"]: r for r in tables.sources(strict=True).collect()}["Source B"]
    assert strict["last_failure"] is None
    assert tables.records().count() == 22 and tables.next_run_id() == 3


def test_lineage_is_stored_on_first_read(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), "lineage", buckets=4).create()
    rows = valid_records(golden.canonical(spark))
    assert tables.save_records(with_fingerprint(rows), 1) == 22
    first = lineage_of(tables, "B-003").first()
    assert (first["source"], first["final_status"], len(first["steps"])) == ("Source B", "STORED", 6)
    assert tables.read("data_lineage").count() == 6
    assert lineage_of(tables, "B-003").first() == first
    assert lineage_of(tables, "nobody").count() == 0
    assert lineage_of(tables).count() == 22
    assert tables.read("data_lineage").count() == 132


def test_tables(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), "tables", buckets=4).create().create()
    assert quality_or_compute(tables).first()["overall_score"] == 100.0
    assert health_or_compute(tables).first()["status"] == "HEALTHY"
    quality_or_compute(tables), health_or_compute(tables)
    assert tables.read("quality_metrics").count() == tables.read("pipeline_health").count() == 1
    alert = spark.createDataFrame([("x", "HIGH"), ("y", "LOW")], "id string, severity string")
    alert = alert.withColumns({"status": F.lit("ACTIVE"), "timestamp": F.current_timestamp()})
    tables.save_alerts(alert)
    tables.save_alerts(alert)
    changes = spark.createDataFrame([("x", "RESOLVED"), ("none", "RESOLVED")],
                                    "id string, status string")
    tables.set_alert_status(changes, "2026-09-23 00:00:00")
    assert {r["id"]: r["status"] for r in tables.alerts().collect()} == {
        "x": "RESOLVED", "y": "ACTIVE"}
    assert tables.read("alert_status").count() == 1
    plan = tables.read("records").select("record_hash").join(
        tables.read("records").select("record_hash"), "record_hash", "left_anti")
    assert "Exchange hashpartitioning" not in plan._jdf.queryExecution().executedPlan().toString()


def test_stream_equals_batch(spark, tmp_path):
    folders = feed_files(tmp_path)
    tables = Tables(spark, str(tmp_path / "lake"), "streamed", buckets=4).create()
    rows = [streaming.stream_feed(spark, path, name, rank, as_of="2026-09-23 00:00:00")
            for rank, (name, path) in enumerate(folders.items(), 1)]
    stream = rows[0].unionByName(rows[1]).unionByName(rows[2])

    def drain():
        streaming.start_ingest(spark, tables, stream, str(tmp_path / "cp"),
                               as_of="2026-09-23 00:00:00").awaitTermination()

    drain()
    kept = {r["source"]: r["count"] for r in tables.records().groupBy("source").count().collect()}
    assert kept == {"Source A": 10, "Source B": 6, "Source C": 6}
    run = tables.runs().first()
    assert (run["run_id"], run["total_received"], run["total_processed"],
            run["total_duplicates"]) == (1, 31, 22, 8)
    write_lines(tmp_path / "Source_A" / "more.json", [
        json.dumps(dict(zip(schemas.RAW_A.names, r))) for r in
        [golden.FEED_A[0], ("A-100", "New", "new@x.y", "1", "22-09-2026")]])
    drain()
    assert tables.records().count() == 23
    second = tables.runs().filter("run_id = 2").first()
    assert (second["total_received"], second["total_inserted"]) == (2, 1)
    live = streaming.event_stream(spark, tables)
    (streaming.stream_source_state(live).writeStream.outputMode("complete").format("memory")
     .queryName("source_state").trigger(availableNow=True).start().awaitTermination())
    state = {r["source"]: r["last_run"] for r in spark.table("source_state").collect()}
    assert state == {"Source A": 2, "Source B": 1, "Source C": 1}
    assert lifecycle_events(tables.runs()).count() == tables.read("events").count()


def test_recent_duplicates_stream(spark, tmp_path):
    folder = feed_files(tmp_path)["Source B"]
    rows = streaming.stream_feed(spark, folder, "Source B", 2, as_of="2026-09-23 00:00:00")
    (streaming.drop_recent_duplicates(rows.unionByName(rows)).writeStream.format("memory")
     .queryName("recent").trigger(availableNow=True).start().awaitTermination())
    assert spark.table("recent").count() == 10
