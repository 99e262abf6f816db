"""Run-to-run comparison (C1-C4) and replay candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace import contract as K
from millrace.functions.render import round_even

# Metric number, column of a measured run, lower values are better.
_METRICS = [(1, "processed", False), (2, "duplicates", True), (3, "failed", True),
            (4, "latency", True), (5, "quality", False), (6, "anomalies", True)]


def measured_runs(runs: DataFrame, quality: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Run totals with the run's own quality score and anomaly count.
    Quality and anomalies shrink to one row per run before the joins."""
    scores = quality.filter(F.col("run_id").isNotNull()).groupBy("run_id").agg(
        F.max_by("overall_score", "timestamp").alias("quality"))
    counts = anomalies.filter(F.col("run_id").isNotNull()).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("_found"))
    return (runs.join(scores, "run_id", "left").join(counts, "run_id", "left").select(
        "run_id", F.col("total_processed").cast("double").alias("processed"),
        F.col("total_duplicates").cast("double").alias("duplicates"),
        F.col("total_failed").cast("double").alias("failed"),
        F.coalesce("duration_ms", F.lit(0.0)).alias("latency"), "quality",
        F.coalesce("_found", F.lit(0)).cast("double").alias("anomalies")))


def _change(latest: Column, previous: Column, lower_is_better: bool) -> dict[str, Column]:
    diff = latest - previous
    percent = (F.when(previous > 0, F.try_divide(diff, previous) * 100.0)
               .when(latest > 0, 100.0).otherwise(0.0))
    better = diff < 0 if lower_is_better else diff > 0
    status = (F.when(F.abs(diff) < 0.001, "NEUTRAL").when(better, "IMPROVED")
              .otherwise("DEGRADED"))
    return {"latest_value": round_even(latest, 2), "previous_value": round_even(previous, 2),
            "absolute_change": round_even(diff, 2), "percent_change": round_even(percent, 1),
            "status": status}


def _metric_rows(pairs: DataFrame) -> DataFrame:
    """Pairs (``a`` = latest, ``b`` = previous) as one row per metric."""
    rows = []
    for number, column, lower in _METRICS:
        latest, previous = F.col("a")[column], F.col("b")[column]
        if column == "quality":
            latest = F.coalesce(latest, F.lit(K.COMPARE_LATEST_QUALITY))
            previous = F.coalesce(previous, F.lit(K.COMPARE_PREVIOUS_QUALITY))
        change = _change(latest, previous, lower)
        rows.append(F.struct(F.lit(number).alias("metric_no"),
                             F.lit(K.METRIC_NAMES[number - 1]).alias("name"),
                             *[c.alias(n) for n, c in change.items()]))
    return (pairs.select(F.col("a.run_id").alias("latest_run_id"),
                         F.col("b.run_id").alias("previous_run_id"),
                         F.explode(F.array(*rows)).alias("m"))
            .select("latest_run_id", "previous_run_id", "m.*"))


def compare_all(measured: DataFrame) -> DataFrame:
    """Every run against the one before it (one row per run is ordered)."""
    row = F.struct(*measured.columns)
    before = F.lag(row).over(W.orderBy("run_id"))
    return _metric_rows(measured.select(row.alias("a"), before.alias("b"))
                        .filter(F.col("b").isNotNull()))


def compare_runs(measured: DataFrame, latest: int | None = None,
                 previous: int | None = None) -> DataFrame:
    """Two given runs, else the latest two, else the only run with itself.
    An unknown or missing run raises ValueError, and so does one id without the other."""
    if (latest is None) != (previous is None):
        raise ValueError("give both runs or none")
    if latest is not None and previous is not None:
        ids = [r[0] for r in measured.filter(F.col("run_id").isin(latest, previous))
               .select("run_id").distinct().collect()]
        missing = {latest, previous} - set(ids)
        if missing:
            raise ValueError(f"no run {sorted(missing)} to compare")
    else:
        ids = [r[0] for r in measured.select("run_id").orderBy(F.desc("run_id"))
               .limit(2).collect()]
        if not ids:
            raise ValueError("no runs to compare")
        latest, previous = ids[0], ids[-1]
    row = F.struct(*measured.columns)
    before = measured.filter(F.col("run_id") == previous).select(row).scalar()
    return _metric_rows(measured.filter(F.col("run_id") == latest)
                        .select(row.alias("a"), before.alias("b")))


def replay_candidates(runs: DataFrame) -> DataFrame:
    """Runs that did not complete."""
    return runs.filter(F.col("status") != "COMPLETED")
