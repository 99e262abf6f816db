"""Run and source accounting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace import contract as K


def run_status(total_failed: Column, sources: Column) -> Column:
    """A2: no failed source is COMPLETED (also with no sources), all failed is FAILED."""
    return (F.when(total_failed == 0, "COMPLETED")
            .when(total_failed == sources, "FAILED").otherwise("PARTIAL"))


def run_totals(outcomes: DataFrame, processed: DataFrame, valid: DataFrame) -> DataFrame:
    """A1, A2: one row per run from source outcomes (run_id, source, status,
    received), processed rows and valid rows (run_id each).

    Each input shrinks to one row per run before they meet, so this needs no join.
    """
    parts = [
        outcomes.groupBy("run_id").agg(
            F.sum("received").alias("total_received"),
            F.count_if(F.col("status") != "SUCCESS").alias("total_failed"),
            F.count(F.lit(1)).alias("_sources")),
        processed.groupBy("run_id").agg(F.count(F.lit(1)).alias("total_processed")),
        valid.groupBy("run_id").agg(F.count(F.lit(1)).alias("_valid")),
    ]
    columns = ["total_received", "total_failed", "_sources", "total_processed", "_valid"]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    totals = merged.groupBy("run_id").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in columns])
    return totals.select(
        "run_id", run_status(F.col("total_failed"), F.col("_sources")).alias("status"),
        "total_received", "total_processed",
        (F.col("_valid") - F.col("total_processed")).alias("total_duplicates"), "total_failed")


def source_status_rows(outcomes: DataFrame, processed: DataFrame, valid: DataFrame,
                       at: Column) -> DataFrame:
    """A3: per run and source HEALTHY or DEGRADED, times, counts and the error.

    ``records_processed`` is the number of rows kept from that source.
    """
    keys = ["run_id", "source"]
    kept = processed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_kept"))
    good = valid.groupBy(*keys).agg(F.count(F.lit(1)).alias("_valid"))
    ok = F.col("status") == "SUCCESS"
    return (outcomes.join(kept, keys, "left").join(good, keys, "left").select(
        "source",
        F.when(ok, "HEALTHY").otherwise("DEGRADED").alias("status"),
        F.when(ok, at).alias("last_success"), F.when(~ok, at).alias("last_failure"),
        F.col("received").cast("bigint").alias("records_received"),
        F.coalesce("_kept", F.lit(0)).cast("bigint").alias("records_processed"),
        (F.coalesce("_valid", F.lit(0)) - F.coalesce("_kept", F.lit(0))).cast("bigint")
        .alias("duplicates"),
        F.col("error").alias("error_message"), "run_id", at.alias("updated_at")))


def lifetime_stats(runs: DataFrame) -> DataFrame:
    """A4, A5: null-safe sums over all runs and the newest run's status, time and
    duration, in one aggregate; an empty table gives zeros and nulls."""
    last = F.max_by(F.struct("status", F.coalesce("completed_at", "started_at").alias("ts"),
                             "duration_ms"), "run_id")
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in
            ("total_received", "total_processed", "total_duplicates", "total_failed")]
    return runs.agg(*sums, last.alias("_last")).select(
        "total_received", "total_processed", "total_duplicates", "total_failed",
        F.col("_last.status").alias("last_run_status"),
        F.col("_last.ts").alias("last_run_timestamp"),
        F.col("_last.duration_ms").alias("last_run_duration_ms"))


def anomaly_summary(anomalies: DataFrame) -> DataFrame:
    """Total and per-severity counts."""
    return anomalies.agg(
        F.count(F.lit(1)).alias("total_anomalies"),
        *[F.count_if(F.col("severity") == s).alias(f"{s.lower()}_count")
          for s in ("HIGH", "MEDIUM", "LOW")])


def active_count(alerts: DataFrame) -> DataFrame:
    """ACTIVE alerts among the given ones."""
    return alerts.agg(F.count_if(F.col("status") == "ACTIVE").alias("active_count"))


def source_cards(sources: DataFrame) -> DataFrame:
    """Received, processed and their difference, never below zero."""
    return sources.select("source", "status", "records_received", "records_processed",
                          F.greatest(F.lit(0), F.col("records_received")
                                     - F.col("records_processed")).alias("duplicates"))


def fold_status(sources: DataFrame) -> DataFrame:
    """Health texts outside the known set read as UNKNOWN."""
    known = F.col("status").isin(K.SOURCE_HEALTH)
    return sources.withColumn("status", F.when(known, F.col("status")).otherwise("UNKNOWN"))


def with_failed_sources(runs: DataFrame) -> DataFrame:
    """Names of the sources that did not succeed."""
    bad = F.filter("source_results", lambda r: r["status"] != "SUCCESS")
    return runs.withColumn("failed_sources", F.transform(bad, lambda r: r["source"]))


def run_documents(runs: DataFrame) -> DataFrame:
    """Stored run as read back: null duration is 0.0, times are ISO text,
    a missing start is ''."""
    from millrace.functions.instants import iso_format
    return (runs.withColumn("duration_ms", F.coalesce("duration_ms", F.lit(0.0)))
            .withColumn("started_at", F.coalesce(iso_format("started_at"), F.lit("")))
            .withColumn("completed_at", iso_format("completed_at")))
