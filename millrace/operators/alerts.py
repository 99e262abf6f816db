"""Alert rules (L1-L7). All rules over one input are raised in one pass over it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace import contract as K
from millrace.functions.asof import AsOf, as_instant
from millrace.functions.identity import content_id
from millrace.functions.render import fill


def _alert(rule: str, severity: Column, source: Column, run: Column,
           title: list[Column], text: list[Column], identity: list[Column]) -> Column:
    """Texts, ACTIVE state and an id made of the rule and what it found."""
    head, body = K.ALERT_TEXTS[rule]
    return F.struct(
        content_id("alert-", F.lit(rule), run, source, *identity).alias("id"),
        severity.alias("severity"), fill(head, *title).alias("title"),
        fill(body, *text).alias("description"), source.alias("source"),
        F.lit("ACTIVE").alias("status"), run.cast("bigint").alias("run_id"),
        F.lit(None).cast("string").alias("record_id"))


def _raised(rows: DataFrame, *rules: tuple[Column, Column]) -> DataFrame:
    """One row per rule (condition, alert) that holds, in one pass over ``rows``."""
    return rows.select(F.inline(F.array_compact(F.array(*[F.when(c, a) for c, a in rules]))))


def source_alerts(sources: DataFrame) -> DataFrame:
    """L1: sources that report trouble, with the error of their last load."""
    name, status = F.col("source"), F.col("status")
    error = (F.coalesce(F.nullif("error_message", F.lit("")), F.lit("Unknown error"))
             if "error_message" in sources.columns else F.lit("Unknown error"))
    seen = [F.col("run_id")] if "run_id" in sources.columns else []
    return _raised(sources, (status.isin(K.ALERT_SOURCE_STATES), _alert(
        "source", F.lit("HIGH"), name, F.lit(None).cast("bigint"), [name], [name, status, error],
        [status, *seen])))


def run_alerts(runs: DataFrame, latest_only: bool = True) -> DataFrame:
    """L2-L4 for the latest run, or for every run."""
    if latest_only:
        runs = runs.filter(F.col("run_id") == runs.agg(F.max("run_id")).scalar())
    run, ms = F.col("run_id"), F.col("duration_ms")
    received, duplicates = F.col("total_received"), F.col("total_duplicates")
    failed = F.col("total_failed")
    percent = F.try_divide(duplicates, received) * 100.0
    engine = F.lit(K.ORCHESTRATOR)
    return _raised(
        runs,
        (ms > K.ALERT_LATENCY_MS,
         _alert("latency", F.lit("MEDIUM"), engine, run, [run], [run, ms], [])),
        (percent > K.ALERT_DUPLICATE_PERCENT,
         _alert("duplicates", F.lit("MEDIUM"), F.lit(K.DEDUPLICATOR), run, [percent, run],
                [duplicates, received], [])),
        (failed > 0,
         _alert("failed", F.lit("HIGH"), engine, run, [run], [failed, run], [])))


def cluster_alerts(anomalies: DataFrame) -> DataFrame:
    """Three or more active anomalies; more than five are HIGH."""
    on = F.col("status") == "ACTIVE"
    # The newest run is part of the identity: a later scan that finds as many raises again.
    run = F.col("run_id") if "run_id" in anomalies.columns else F.lit(None).cast("bigint")
    active = anomalies.agg(F.count_if(on).alias("n"), F.max(F.when(on, run)).alias("newest"))
    n = F.col("n")
    severity = F.when(n > K.ALERT_CLUSTER_HIGH, "HIGH").otherwise("MEDIUM")
    return _raised(active, (n >= K.ALERT_CLUSTER_MIN, _alert(
        "cluster", severity, F.lit(K.ANOMALY_ENGINE), F.lit(None).cast("bigint"), [n], [n],
        [n, F.col("newest")])))


def scan_alerts(sources: DataFrame, runs: DataFrame, anomalies: DataFrame, *,
                latest_only: bool = True, as_of: AsOf = None) -> DataFrame:
    """All alerts that hold now, as rows of ``alerts``."""
    found = reduce(DataFrame.unionByName, [
        source_alerts(sources), run_alerts(runs, latest_only), cluster_alerts(anomalies)])
    return found.withColumn("timestamp", as_instant(as_of))
