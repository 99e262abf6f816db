"""Additive counters of a run's records, from which scores and value statistics of the whole
store follow without reading the records of earlier runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.exact import SUMS, Moments, band_of, band_sums, moments_of
from millrace.operators.anomaly import stats_row
from millrace.operators.quality import SUMMED, quality_counters


def run_counters(records: DataFrame) -> DataFrame:
    """One row per source: the quality counters, and exact sums of its finite values by band. One
    pass; each task sends a row per source and band."""
    banded = records.withColumn("_band", band_of(F.col("value")))
    per = banded.groupBy("source", F.col("_band").alias("band")).agg(
        *quality_counters(records), *band_sums(F.col("value"), F.col("_band")))
    return per.groupBy("source").agg(
        *[F.sum(c).alias(c) for c in SUMMED], F.max("newest_ingested_at").alias("newest_ingested_at"),
        F.sum("n").alias("n"),
        F.collect_list(F.when(F.col("band").isNotNull(), F.struct("band", "n", *SUMS))).alias("moments"))


def moments_in(counters: DataFrame) -> Moments:
    """Exact moments of all values that were counted; one row per band reaches the driver."""
    bands = counters.select(F.inline("moments")).groupBy("band").agg(*[F.sum(c).alias(c) for c in ("n", *SUMS)])
    return moments_of(bands.collect())


def value_stats_of(counters: DataFrame, first_run: bool = False) -> DataFrame:
    """M1-M3 from counters, equal to value_stats() over the values themselves. Values of a first run
    count twice."""
    return stats_row(counters.sparkSession, moments_in(counters), 2 if first_run else 1)
