"""Quality, anomalies, forest, health, alerts and comparison, with exact numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import alerts, anomaly, compare, forest, health, quality, runs, upsert
from millrace.functions.render import fill, fixed, round_even

AS_OF = "2026-09-23 00:00:00"
REC = "record_id string, name string, email string, value double, source string, " \
      "created_at string, ingested_at string, record_hash string"


def records(spark, rows):
    frame = spark.createDataFrame(rows, REC)
    return frame.withColumns({c: F.col(c).cast("timestamp") for c in ("created_at", "ingested_at")})


def rec(i, name="n", email="a@b.c", value=1.0, source="A", created="2026-09-22",
        at="2026-09-23 00:00:00", digest=None):
    return (f"r{i}", name, email, value, source, created, at, digest or f"h{i}")


def test_rounding(spark):
    values = [0.25, 2.675, 94.65, 41.25, 0.35, -0.25, 1e6 + 0.05, 12.0]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    got = frame.select(round_even(F.col("v"), 1), round_even(F.col("v"), 2),
                       fixed(F.col("v"), 1)).collect()
    assert [tuple(r) for r in got] == [(round(v, 1), round(v, 2), f"{v:.1f}") for v in values]
    text = frame.limit(1).select(fill("%s: %.1f%% of %d", F.lit("x"), F.lit(41.25), F.lit(7)))
    assert text.first()[0] == "x: 41.2% of 7"


SCORES = ["overall_score", "completeness", "validity", "consistency", "uniqueness", "freshness"]


def test_quality(spark):
    clean = records(spark, [rec(1), rec(2)])
    assert [quality.quality_scores(clean, AS_OF).first()[c] for c in SCORES] == [100.0] * 6
    dirty = records(spark, [
        rec(1, name=None, source="A"), rec(2, email="A@b.c", value=-1.0, source="A"),
        rec(3, email=None, value=float("nan"), created=None, source=None, digest="h1"),
        rec(4, name="", source="B", at="2026-09-22 14:00:00")])
    row = quality.quality_snapshot(dirty, 7, AS_OF).first()
    assert (row["completeness"], row["validity"], row["consistency"], row["uniqueness"],
            row["freshness"]) == (round(11 / 16 * 100, 1), 50.0, 50.0, 75.0, 100.0)
    assert row["overall_score"] == round(.25 * 68.75 + .25 * 50 + .2 * 50 + .15 * 75 + 15, 1)
    assert row["quality_by_source"] == {"A": round(5 / 6 * 100, 1), "B": round(2 / 3 * 100, 1)}
    assert row["details"]["total_records_evaluated"] == "4" and row["run_id"] == 7
    per = {r["source"]: r["completeness"] for r in quality.quality_by_source(dirty).collect()}
    assert per == row["quality_by_source"]


@pytest.mark.parametrize("hours, score", [(0, 100.0), (5, 90.0), (30, 50.0), (-9, 100.0)])
def test_freshness(spark, hours, score):
    frame = records(spark, [rec(1)]).withColumn(
        "ingested_at", F.lit(AS_OF).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours)))
    assert quality.quality_scores(frame, AS_OF).first()["freshness"] == score


def test_quality_of_nothing_and_missing_columns(spark):
    empty = records(spark, [])
    row = quality.quality_snapshot(empty, None, AS_OF).first()
    assert [row[c] for c in SCORES] == [100.0] * 6 and row["quality_by_source"] == {}
    assert row["details"] == {"message": "No records in repository yet"}
    bare = records(spark, [rec(1)]).drop("name", "record_hash", "ingested_at")
    row = quality.quality_scores(bare, AS_OF).first()
    assert (row["completeness"], row["uniqueness"], row["freshness"]) == (75.0, 100.0, 95.0)
    text = records(spark, [rec(1), rec(2)]).withColumn("ingested_at", F.lit("2026-09-22T14:00:00Z"))
    assert quality.quality_scores(text, AS_OF).first()["freshness"] == 80.0
    text = text.withColumn("ingested_at", F.when(F.col("record_id") == "r1", "soon"))
    assert quality.quality_snapshot(text, 1, AS_OF).first()["freshness"] == 90.0
    assert quality.quality_scores(records(spark, [rec(i) for i in range(5)]), AS_OF,
                                  limit=2).first()["rows"] == 2


def values(spark, numbers):
    return records(spark, [rec(i, value=v) for i, v in enumerate(numbers)]).repartition(3)


def test_value_anomalies(spark):
    frame = values(spark, [*map(float, range(10, 20)), 9999.0])
    stats = anomaly.value_stats(frame).first()
    assert stats["n"] == 22
    assert [round(stats[c], 4) for c in ("mean", "std", "low", "high")] == [
        922.1818, 2870.3432, 0.0, 8098.0399]
    found = anomaly.detect_value_anomalies(frame, run_id=3, as_of=AS_OF).collect()
    big = [r for r in found if r["current_value"] == 9999.0]
    assert len(big) == 1 and big[0]["severity"] == "MEDIUM" and big[0]["run_id"] == 3
    assert big[0]["expected_range"] == "0.0 – 8098.0"
    assert big[0]["reason"] == ("Record value (9999.00) is significantly outside historical normal "
                                "range [0.00 – 8098.04]. Historical mean: 922.18, Std dev: 2870.34.")
    again = anomaly.detect_value_anomalies(frame.repartition(1), run_id=3, as_of=AS_OF)
    assert {r["id"] for r in again.collect()} == {r["id"] for r in found}


def test_value_anomaly_limits(spark):
    few = values(spark, [1.0, 900.0])
    assert anomaly.value_anomalies(few, as_of=AS_OF).count() == 0
    odd = values(spark, [1.0] * 6 + [float("nan"), float("inf")])
    assert [r["severity"] for r in anomaly.value_anomalies(odd).collect()] == ["HIGH", "HIGH"]
    history = values(spark, [float(v) for v in range(100)])
    scan = values(spark, [50.0, 500.0, None])
    found = anomaly.value_anomalies(scan, history).collect()
    assert [(r["current_value"], r["severity"]) for r in found] == [(500.0, "HIGH")]


def test_leaves_follow_the_splits():
    rng = np.random.default_rng(1)
    sample = np.sort(rng.normal(size=64))
    leaves = forest.isolation_leaves(sample, np.random.default_rng(2))
    uppers = [u for u, _ in leaves]
    assert uppers == sorted(uppers) and uppers[-1] == math.inf
    inside = np.searchsorted(np.array(uppers), sample, side="left")
    counts = np.bincount(inside, minlength=len(leaves))
    assert counts.min() >= 1 and counts.sum() == 64
    assert all(path >= forest.path_adjustment(n) for (_, path), n in zip(leaves, counts))
    assert max(path - forest.path_adjustment(n) for (_, path), n in zip(leaves, counts)) <= 6
    assert [forest.path_adjustment(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert forest.isolation_leaves(np.array([3.0, 3.0]), rng) == [(math.inf, 1.0)]


def test_forest(spark):
    rng = np.random.default_rng(5)
    numbers = [*rng.normal(100, 10, 3000), 1000.0, -500.0]
    frame = values(spark, [float(v) for v in numbers]).select("value", "record_hash")
    model = forest.fit_forest(frame, ("record_hash",))
    other = forest.fit_forest(frame.repartition(11), ("record_hash",))
    assert np.array_equal(model.borders, other.borders) and model.threshold == other.threshold
    scores = np.array([model.score(v) for v in numbers])
    assert model.threshold == pytest.approx(np.quantile(scores, 0.9), abs=1e-12)
    bad = {float(v) for v, s in zip(numbers, scores) if s > model.threshold}
    assert {1000.0, -500.0} <= bad and 0.05 < len(bad) / len(numbers) <= 0.101
    flagged = {r["value"] for r in frame.filter(model.flags("value")).collect()}
    assert flagged == bad
    assert forest.fit_forest(frame.limit(0), ("record_hash",)) is None


def run_rows(spark, *rows):
    """(run_id, status, received, processed, duplicates, failed, duration)"""
    return spark.createDataFrame(list(rows), "run_id long, status string, total_received long, "
                                 "total_processed long, total_duplicates long, total_failed long, "
                                 "duration_ms double")


def durations(spark, *ms):
    return run_rows(spark, *[(i + 1, "COMPLETED", 1, 1, 0, 0, m) for i, m in enumerate(ms)])


def test_run_anomalies(spark):
    found = anomaly.run_anomalies(durations(spark, 100.0, 110.0, 90.0, 500.0), as_of=AS_OF).first()
    std = float(np.std([100, 110, 90]))
    assert (found["run_id"], found["severity"], found["record_id"]) == (4, "HIGH", None)
    assert found["expected_range"] == f"<{100 + 2 * std:.1f} ms"
    assert found["reason"] == (f"Ingestion run duration (500.0 ms) exceeded historical baseline "
                               f"[{100 - std:.1f} ms – {100 + 2 * std:.1f} ms].")
    assert anomaly.run_anomalies(durations(spark, 100.0, 110.0, 500.0)).count() == 0
    same = durations(spark, 100.0, 100.0, 100.0, 226.0, 224.0)
    base = {r["run_id"]: r for r in anomaly.run_baseline(same).collect()}
    assert base[2]["std"] == 100.0 and base[4]["std"] == 50.0
    assert [r["run_id"] for r in anomaly.run_anomalies(same, latest_only=False).collect()] == [4]
    none = durations(spark, 0.0, None, 0.0, 900.0)
    assert anomaly.run_anomalies(none, latest_only=False).count() == 0


def sources(spark, *rows):
    return spark.createDataFrame(list(rows), "source string, status string")


@pytest.mark.parametrize("anomalies, overall", [(0, 95.9), (1, 94.9), (2, 93.9)])
def test_health(spark, anomalies, overall):
    one = run_rows(spark, (1, "COMPLETED", 31, 22, 8, 0, 1502.0))
    ok = sources(spark, *[(s, "HEALTHY") for s in "ABC"])
    row = health.pipeline_health(one, ok, spark.range(anomalies), AS_OF).first()
    assert (row["availability"], row["latency"], row["validation"]) == (100.0, 95.0, 96.8)
    assert row["reliability"] == round(100 - 8 / 31 * 40 - 5 * anomalies, 1)
    assert (row["overall_score"], row["status"]) == (overall, "HEALTHY")


def test_health_windows_and_bands(spark):
    old = [(i, "FAILED", 100, 0, 0, 3, 50000.0) for i in range(1, 3)]
    new = [(i, "PARTIAL", 10, 10, 0, 1, 5000.0) for i in range(3, 13)]
    row = health.pipeline_health(run_rows(spark, *old, *new), sources(spark), spark.range(0)).first()
    assert (row["availability"], row["latency"], row["validation"]) == (0.0, 60.0, 100.0)
    assert (row["overall_score"], row["status"]) == (60.0, "DEGRADED")
    bad = health.pipeline_health(run_rows(spark, *old), sources(spark), spark.range(30)).first()
    assert (bad["latency"], bad["validation"], bad["reliability"], bad["status"]) == (
        20.0, 0.0, 10.0, "CRITICAL")
    none = health.pipeline_health(run_rows(spark), sources(spark), spark.range(9)).first()
    assert (none["overall_score"], none["status"]) == (100.0, "HEALTHY")


def test_alerts(spark):
    found = spark.createDataFrame([("ACTIVE",)] * 3 + [("RESOLVED",)] * 9, "status string")
    status = spark.createDataFrame([("A", "DEGRADED", "boom"), ("B", "HEALTHY", None),
                                    ("C", "DOWN", None), ("D", "FAILED", "")],
                                   "source string, status string, error_message string")
    rows = run_rows(spark, (1, "FAILED", 10, 1, 9, 3, 9000.0), (2, "PARTIAL", 160, 100, 66, 1, 3000.1))
    got = alerts.scan_alerts(status, rows, found, as_of=AS_OF).collect()
    texts = {r["title"]: (r["severity"], r["description"], r["source"], r["run_id"]) for r in got}
    assert texts == {
        "Source Degradation: A": ("HIGH", "Source A is currently reporting DEGRADED status. "
                                  "Error: boom", "A", None),
        "Source Degradation: D": ("HIGH", "Source D is currently reporting FAILED status. "
                                  "Error: Unknown error", "D", None),
        "High Run Latency in Run #2": ("MEDIUM", "Ingestion run #2 took 3000.1ms, exceeding 3000ms "
                                       "threshold.", "Pipeline Orchestrator", 2),
        "High Duplicate Rate (41.2%) in Run #2": ("MEDIUM", "Detected 66 duplicates out of 160 "
                                                  "records.", "Deduplicator", 2),
        "Failed Sources in Run #2": ("HIGH", "1 source(s) failed during concurrent ingestion run "
                                     "#2.", "Pipeline Orchestrator", 2),
        "Multiple Active Anomalies (3 detected)": (
            "MEDIUM", "3 active records/runs flagged as anomalies by IsolationForest.",
            "ML Anomaly Engine", None)}
    assert len({r["id"] for r in got}) == 6
    assert alerts.run_alerts(rows, latest_only=False).count() == 6
    edge = run_rows(spark, (1, "COMPLETED", 100, 85, 15, 0, 3000.0))
    assert alerts.run_alerts(edge).count() == 0
    assert upsert.insert_absent(alerts.run_alerts(rows), alerts.run_alerts(rows)).count() == 0


def test_compare(spark):
    rows = run_rows(spark, (1, "COMPLETED", 30, 0, 8, 0, 1000.0), (2, "PARTIAL", 31, 22, 8, 1, 900.0),
                    (3, "FAILED", 0, 11, 0, 3, None))
    none = spark.createDataFrame([], schemas.QUALITY)
    found = spark.createDataFrame([(2,), (2,)], "run_id long")
    measured = compare.measured_runs(rows, none, found)
    got = {r["name"]: tuple(r)[4:] for r in compare.compare_runs(measured, 2, 1).collect()}
    assert got == {"Records Processed": (22.0, 0.0, 22.0, 100.0, "IMPROVED"),
                   "Duplicates": (8.0, 8.0, 0.0, 0.0, "NEUTRAL"),
                   "Validation Errors": (1.0, 0.0, 1.0, 100.0, "DEGRADED"),
                   "Latency (ms)": (900.0, 1000.0, -100.0, -10.0, "IMPROVED"),
                   "Quality Score": (95.0, 90.0, 5.0, 5.6, "IMPROVED"),
                   "Anomalies": (2.0, 0.0, 2.0, 100.0, "DEGRADED")}
    latest = compare.compare_runs(measured).collect()
    assert {(r["latest_run_id"], r["previous_run_id"]) for r in latest} == {(3, 2)}
    only = compare.compare_runs(measured.filter("run_id = 1")).collect()
    assert {r["status"] for r in only if r["name"] != "Quality Score"} == {"NEUTRAL"}
    assert compare.compare_all(measured).count() == 12
    for args in ((measured, 2, 9), (measured.limit(0),)):
        with pytest.raises(ValueError):
            compare.compare_runs(*args)
    assert [r["run_id"] for r in compare.replay_candidates(rows).collect()] == [2, 3]


def test_lifetime_stats(spark):
    rows = run_rows(spark, (1, "PARTIAL", 10, 7, 3, 0, 5.0), (2, "COMPLETED", 20, 15, 4, 1, 6.0))
    rows = rows.withColumns({"started_at": F.lit(AS_OF).cast("timestamp"),
                             "completed_at": F.lit(None).cast("timestamp")})
    row = runs.lifetime_stats(rows).first()
    assert tuple(row)[:5] == (30, 22, 7, 1, "COMPLETED") and str(row[5]) == AS_OF
    assert tuple(runs.lifetime_stats(rows.limit(0)).first()) == (0, 0, 0, 0, None, None, None)
    status = [r[0] for r in spark.createDataFrame([(0, 3), (3, 3), (1, 3), (0, 0)], "f int, n int")
              .select(runs.run_status(F.col("f"), F.col("n"))).collect()]
    assert status == ["COMPLETED", "FAILED", "PARTIAL", "COMPLETED"]
