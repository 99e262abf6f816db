"""Pipeline health score (H1-H7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from millrace import contract as K
from millrace.functions.asof import AsOf, as_instant
from millrace.functions.render import round_even


def _availability(runs: DataFrame, sources: DataFrame) -> DataFrame:
    """H1: share of healthy sources, or of completed runs when no source is known."""
    good = F.count_if(F.col("status").isin("HEALTHY", "SUCCESS"))
    by_source = sources.agg(F.count(F.lit(1)).alias("s"), good.alias("g"))
    by_run = runs.agg(F.count(F.lit(1)).alias("r"),
                      F.count_if(F.col("status") == "COMPLETED").alias("c"))
    src = by_source.select(F.struct("s", "g")).scalar()
    return by_run.withColumn("_src", src).select(
        F.col("r").alias("run_count"),
        F.when(F.col("_src.s") > 0, F.try_divide(F.col("_src.g"), F.col("_src.s")) * 100.0)
        .otherwise(F.try_divide("c", "r") * 100.0).alias("availability"))


def pipeline_health(runs: DataFrame, sources: DataFrame, anomalies: DataFrame,
                    as_of: AsOf = None) -> DataFrame:
    """H1-H7: one row of ``pipeline_health``. The newest runs are a top-k, so the
    run table is never sorted as a whole; the other inputs shrink to one row."""
    newest = (runs.orderBy(F.desc("run_id")).limit(K.HEALTH_LATENCY_RUNS)
              .withColumn("_n", F.row_number().over(W.orderBy(F.desc("run_id")))))
    late = F.col("_n") <= K.HEALTH_VALIDATION_RUNS
    window = newest.agg(
        F.coalesce(F.avg("duration_ms"), F.lit(K.HEALTH_DEFAULT_MS)).alias("ms"),
        *[F.coalesce(F.sum(F.when(late, F.col(f"total_{c}"))), F.lit(0)).alias(c)
          for c in ("received", "processed", "duplicates")])
    available = _availability(runs, sources).select(
        F.struct("run_count", "availability")).scalar()
    found = anomalies.agg(F.count(F.lit(1))).scalar()
    base = window.withColumn("_a", available).withColumn("_found", found)
    received = F.col("received")
    lost = F.greatest(F.lit(0), received - (F.col("processed") + F.col("duplicates")))
    lost_share = F.coalesce(F.try_divide(lost, received), F.lit(0.0))
    duplicate_share = F.coalesce(F.try_divide(F.col("duplicates"), received), F.lit(0.0))

    def clamp(low: float, value):
        return F.greatest(F.lit(low), F.least(F.lit(100.0), value))

    parts = {
        "availability": F.col("_a.availability"),
        "latency": clamp(20.0, 100.0 - F.greatest(F.lit(0.0), (F.col("ms") - 1000.0) / 100.0)),
        "validation": clamp(0.0, 100.0 - lost_share * 100.0),
        "reliability": clamp(10.0, 100.0 - duplicate_share * 40.0 - F.col("_found") * 5.0),
    }
    none = F.col("_a.run_count") == 0
    raw = base.select(*[F.when(none, 100.0).otherwise(c).alias(n) for n, c in parts.items()])
    overall = sum((F.col(n) * w for n, w in K.HEALTH_WEIGHTS.items()), F.lit(0.0))
    scored = raw.withColumn("overall_score", round_even(overall, 1))
    score = F.col("overall_score")
    return scored.select(
        "overall_score", *[round_even(F.col(n), 1).alias(n) for n in parts],
        F.when(score < 50, "CRITICAL").when(score < 80, "DEGRADED")
        .otherwise("HEALTHY").alias("status"),
        as_instant(as_of).alias("updated_at"))
