"""Value and run-duration anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from millrace import contract as K
from millrace.functions.asof import AsOf, as_instant
from millrace.functions.exact import Moments, band_of, band_sums, moments_of
from millrace.functions.identity import content_id
from millrace.functions.render import fill
from millrace.operators.forest import Forest, fit_forest

ANOMALY_COLUMNS = ["id", "run_id", "record_id", "source", "feature_name", "current_value",
                   "expected_range", "severity", "reason", "status", "timestamp"]


def _finite(column: str) -> Column:
    c = F.col(column)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def training_values(scan: DataFrame, history: DataFrame | None) -> DataFrame:
    """M1: the values the statistics are taken over."""
    values = scan.select("value")
    return values if history is None else history.select("value").unionByName(values)


def value_stats(scan: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """M1-M3: one row with n, mean, population std and the bounds, from exact sums: the same to the last
    bit however the rows are partitioned. One row per band of powers of two reaches the driver.

    Without a history the scanned rows are their own history: every value then
    counts twice, which changes n but neither mean nor std.
    """
    values = training_values(scan, history).withColumn("band", band_of(F.col("value")))
    bands = values.groupBy("band").agg(*band_sums(F.col("value"), F.col("band")))
    return stats_row(scan.sparkSession, moments_of(bands.collect()), 2 if history is None else 1)


def stats_row(spark: SparkSession, found: Moments, times: int = 1) -> DataFrame:
    """M2, M3 as one row: n (values counted ``times`` times), mean, std (1 where it is 0), bounds."""
    std = 1.0 if found.std == 0 else found.std
    bounds = (None, None) if found.mean is None else (
        max(0.0, found.mean - K.BOUND_SIGMAS * std), found.mean + K.BOUND_SIGMAS * std)
    return spark.createDataFrame([(found.n * times, found.mean, std, *bounds)],
                                 "n long, mean double, std double, low double, high double")


def score_values(scan: DataFrame, stats: DataFrame) -> DataFrame:
    """M4: adds ``_s`` (the statistics) and ``z`` to every row that has a value.
    The one row of statistics arrives as a scalar subquery; nothing is joined."""
    row = stats.select(F.struct("n", "mean", "std", "low", "high")).scalar()
    s = F.col("_s")
    return (scan.filter(F.col("value").isNotNull()).withColumn("_s", row)
            .withColumn("z", F.abs(F.col("value") - s["mean"]) / s["std"]))


def _severity() -> Column:
    """M8, with values that are not finite always HIGH."""
    s, v, z = F.col("_s"), F.col("value"), F.col("z")
    high = (z > K.HIGH_SIGMAS) | (v > s["mean"] + K.HIGH_SIGMAS * s["std"]) | ~_finite("value")
    return F.when(high, "HIGH").when(z < K.LOW_SIGMAS, "LOW").otherwise("MEDIUM")


def value_anomalies(scan: DataFrame, history: DataFrame | None = None, *,
                    run_id: int | None = None, as_of: AsOf = None,
                    forest: Forest | None = None, stats: DataFrame | None = None) -> DataFrame:
    """Anomalous rows of ``scan`` as rows of ``anomalies``. ``stats`` is
    one row as of value_stats(), where it is known already.

    Fewer than five training values give no rows. Without a ``forest`` only the
    z-score and range conditions apply. Scoring needs no shuffle.
    """
    s, v = F.col("_s"), F.col("value")
    flagged = ((F.col("z") > K.BOUND_SIGMAS) | (v < s["low"]) | (v > s["high"])
               | ~_finite("value"))
    if forest is not None:
        flagged = flagged | forest.flags("value")
    run = (F.lit(run_id) if run_id is not None else
           F.col("run_id") if "run_id" in scan.columns else F.lit(None)).cast("bigint")
    identity = [c for c in ("record_hash",) if c in scan.columns]
    rows = score_values(scan, value_stats(scan, history) if stats is None else stats).filter(
        (s["n"] >= K.ANOMALY_MIN_VALUES) & flagged)
    return rows.select(
        content_id("anom-", run, "record_id", *identity, F.lit("value"), v).alias("id"),
        run.alias("run_id"),
        F.coalesce(F.nullif("record_id", F.lit("")), F.lit("N/A")).alias("record_id"),
        F.coalesce(F.nullif("source", F.lit("")), F.lit("Unknown")).alias("source"),
        F.lit("value").alias("feature_name"), v.alias("current_value"),
        fill(K.VALUE_RANGE, s["low"], s["high"]).alias("expected_range"),
        _severity().alias("severity"),
        fill(K.VALUE_REASON, v, s["low"], s["high"], s["mean"], s["std"])
        .alias("reason"),
        F.lit("ACTIVE").alias("status"), as_instant(as_of).alias("timestamp"))


def detect_value_anomalies(scan: DataFrame, history: DataFrame | None = None, *,
                           keys: tuple[str, ...] = ("record_hash",), run_id: int | None = None,
                           as_of: AsOf = None) -> DataFrame:
    """M1-M9 with the isolation forest fitted on history and scan."""
    training = scan if history is None else history.select("value", *keys).unionByName(
        scan.select("value", *keys))
    forest = fit_forest(training, keys)
    return value_anomalies(scan, history, run_id=run_id, as_of=as_of, forest=forest)


def run_baseline(runs: DataFrame) -> DataFrame:
    """Per run the count, mean and std of the durations of all earlier runs.
    One row per run, so the single ordering over runs stays small."""
    before = W.orderBy("run_id").rowsBetween(W.unboundedPreceding, -1)
    used = F.when(F.col("duration_ms") != 0, F.col("duration_ms"))
    return (runs.select("run_id", "duration_ms",
                        F.count(F.lit(1)).over(before).alias("history_runs"),
                        F.count(used).over(before).alias("durations"),
                        F.avg(used).over(before).alias("mean"),
                        F.stddev_pop(used).over(before).alias("_std"))
            .withColumn("std", F.when(F.col("durations") == 1, K.RUN_SINGLE_STD)
                        .when(F.col("_std") == 0, K.RUN_ZERO_STD).otherwise(F.col("_std")))
            .drop("_std"))


def run_anomalies(runs: DataFrame, *, latest_only: bool = True, as_of: AsOf = None) -> DataFrame:
    """Runs that took longer than their history explains."""
    scored = run_baseline(runs)
    if latest_only:
        scored = scored.filter(F.col("run_id") == runs.agg(F.max("run_id")).scalar())
    mean, std, ms = F.col("mean"), F.col("std"), F.coalesce("duration_ms", F.lit(0.0))
    late = scored.filter((F.col("history_runs") >= K.RUN_MIN_HISTORY) & (F.col("durations") > 0)
                         & (ms > mean + K.BOUND_SIGMAS * std))
    return late.select(
        content_id("anom-run-", "run_id", F.lit("duration_ms"), ms).alias("id"), "run_id",
        F.lit(None).cast("string").alias("record_id"), F.lit(K.ORCHESTRATOR).alias("source"),
        F.lit("duration_ms").alias("feature_name"), ms.alias("current_value"),
        fill(K.RUN_RANGE, mean + 2 * std).alias("expected_range"),
        F.lit("HIGH").alias("severity"),
        fill(K.RUN_REASON, ms, mean - std, mean + 2 * std).alias("reason"),
        F.lit("ACTIVE").alias("status"), as_instant(as_of).alias("timestamp"))
