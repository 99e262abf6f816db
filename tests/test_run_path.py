"""The run path: files as they arrive, repeated runs, replays without copies, alerts raised again."""

import json
import os

import pytest
from pyspark.sql import functions as F

from millrace.operators.alerts import cluster_alerts
from millrace.operators.compare import compare_runs
from millrace.operators.events import run_state
from millrace.operators.reads import quality_trend
from millrace.operators.upsert import insert_absent
from millrace.plans.ingest import replay_run, run_ingestion, store_batch
from millrace.sinks.tables import Tables
from millrace.sources.feeds import file_source, payload_source

AS_OF = "2025-02-04 00:00:00"


def write_lines(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))


def person(key, value, name="N"):
    return {"userId": key, "username": name, "mail": f"{key.lower()}@x.yz",
            "transaction_value": value, "createdAt": "2025-02-03T08:15:00"}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("path"))
    return Tables(spark, root, "run_path", buckets=4).create()


def test_numbers_sent_as_text_are_kept(spark, tmp_path):
    write_lines(tmp_path / "in" / "a.json", [person("C-1", "41.5"), person("C-2", 7), person("C-3", "x")])
    spec = file_source("Source C", 3, str(tmp_path / "in"))
    rows = spec.canonical(spec.raw(spark)).orderBy("pos").collect()
    assert [r["value"] for r in rows] == [41.5, 7.0, None]


def test_typed_files_bring_their_schema(spark, tmp_path):
    spark.createDataFrame([person("C-1", 41.5)]).write.parquet(str(tmp_path / "p"))
    spec = file_source("Source C", 3, str(tmp_path / "p"), "parquet")
    assert spec.canonical(spec.raw(spark)).first()["value"] == 41.5


def test_first_file_wins(spark, tmp_path):
    write_lines(tmp_path / "in" / "part-0.json", [person("A-1", 1, "first")])
    write_lines(tmp_path / "in" / "part-1.json",
                [person("A-1", 2, "second")] + [person(f"Z-{i}", i) for i in range(2000)])
    spec = file_source("Source C", 3, str(tmp_path / "in"))
    rows = spec.canonical(spec.raw(spark))
    own = rows.filter("record_id = 'A-1'").orderBy("pos").collect()
    assert [r["name"] for r in own] == ["first", "second"]
    places = [r["record_id"] for r in rows.orderBy("pos").collect()]
    assert places[:3] == ["A-1", "A-1", "Z-0"] and places[-1] == "Z-1999"


def test_mixed_source_repeat_and_replay(spark, lake, tmp_path):
    write_lines(tmp_path / "in" / "a.json", [person("C-1", 1), person("C-2", 2), person("C-2", 3)])
    specs = [payload_source("Feed M", 1, str(tmp_path / "in"))]
    for _ in range(2):
        run = run_ingestion(spark, lake, specs, run_id=1, as_of=AS_OF, forest=False).first()
        assert (run["total_received"], run["total_processed"], run["total_inserted"]) == (3, 2, 2)
    status = lake.sources().first()
    assert (status["source"], status["records_received"], status["records_processed"],
            status["duplicates"]) == ("Feed M", 3, 2, 1)
    assert not os.path.exists(f"{lake.root}/staged/run_id=1")
    again, _ = replay_run(spark, lake, 1, specs=specs, as_of=AS_OF, forest=False)
    row = again.first()
    assert (row["total_received"], row["total_processed"], row["total_inserted"]) == (3, 2, 0)
    assert row["source_results"][0]["raw_path"] == run["source_results"][0]["raw_path"]
    assert not [d for d, _, _ in os.walk(lake.raw_root) if f"run_id={row['run_id']}" in d]


def test_bucket_count_is_the_tables(spark, lake):
    again = Tables(spark, lake.root, "run_path", buckets=13).create()
    assert again.buckets == 4


def test_unreadable_table_is_no_empty_table(spark, lake, monkeypatch):
    assert lake.read("rejects").count() >= 0
    monkeypatch.setattr(lake, "folder", lambda table: "nosuchscheme://x/y")
    with pytest.raises(Exception):
        lake.read("rejects").count()


def test_cluster_alert_is_raised_again_by_a_later_run(spark):
    def scan(run):
        rows = [(f"a{i}", "ACTIVE", run) for i in range(4)]
        return cluster_alerts(spark.createDataFrame(rows, "id string, status string, run_id long"))

    first = scan(1)
    assert insert_absent(scan(1), first).count() == 0
    assert insert_absent(scan(2), first).count() == 1


def test_last_status_counts(spark):
    rows = [("INGESTION_COMPLETED", 1, None, "PARTIAL", 1), ("SOURCE_COMPLETED", 1, "S", None, 2),
            ("SOURCE_COMPLETED", 1, "S", None, 3), ("INGESTION_COMPLETED", 1, None, "COMPLETED", 4)]
    events = spark.createDataFrame(
        rows, "event string, run_id long, source string, status string, t long").select(
        "event", "run_id", "source", "status", F.timestamp_seconds("t").alias("timestamp"),
        F.lit(None).cast("bigint").alias("records"))
    state = run_state(events).first()
    assert (state["status"], state["sources_completed"]) == ("COMPLETED", 1)


def test_trend_is_not_cut(spark):
    snaps = spark.range(300).select(
        F.col("id").alias("run_id"), F.timestamp_seconds("id").alias("timestamp"),
        *[F.lit(1.0).alias(c) for c in ("overall_score", "completeness", "validity", "consistency",
                                        "uniqueness", "freshness")])
    assert quality_trend(snaps, 250).count() == 250
    with pytest.raises(ValueError):
        quality_trend(snaps, 0)


def test_one_run_alone_is_no_comparison(spark):
    with pytest.raises(ValueError):
        compare_runs(spark.range(3).withColumnRenamed("id", "run_id"), latest=2)


def test_stored_batch_counts_by_source_of_the_run(spark, lake):
    rows = [("R-1", "n", "e@x.yz", 1.0, s, rank, pos) for s, rank, pos in
            (("Source A", 7, 0), ("Source B", 7, 1), ("Source B", 8, 0))]
    frame = spark.createDataFrame(
        rows, "record_id string, name string, email string, value double, source string, "
        "source_rank int, pos long").withColumns({
            "created_at": F.lit(AS_OF).cast("timestamp"), "ingested_at": F.lit(AS_OF).cast("timestamp")})
    counts, inserted = store_batch(spark, lake, frame, 50, {7: "Mixed", 8: "Other"})
    assert counts == {"Mixed": (2, 2, 1), "Other": (1, 1, 0)} and inserted == 1


def test_counters_give_the_statistics_of_the_values(spark):
    from millrace.operators.anomaly import value_stats
    from millrace.operators.counters import run_counters, value_stats_of

    rows = [(s, "n", "e@x.yz", v, AS_OF, f"h{k}") for k, (s, v) in enumerate(
        [("A", 1e9 + 1), ("A", 1e9 + 4), ("B", 1e9), ("B", float("nan")), ("C", None), (None, 1e9 + 9)])]
    records = spark.createDataFrame(rows, "source string, name string, email string, value double, "
                                    "created_at string, record_hash string").withColumn(
        "created_at", F.col("created_at").cast("timestamp"))
    got = value_stats_of(run_counters(records)).first()
    want = value_stats(records, records.limit(0)).first()
    assert got["n"] == want["n"] == 4
    assert got["mean"] == pytest.approx(want["mean"]) and got["std"] == pytest.approx(want["std"], abs=1e-6)
    assert value_stats_of(run_counters(records.limit(0))).first()["n"] == 0
