"""Sorted, paged and point reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window as W, functions as F

from millrace import contract as K
from millrace.functions.render import fill
from millrace.operators.validate import items_where, records_of

NEWEST = ("ingested_at", "record_hash")


def records_page(records: DataFrame, page: int = 1, page_size: int = K.PAGE_SIZE,
                 source: str | None = None) -> DataFrame:
    """One page, newest first. Spark plans a top-k of offset + limit rows, so
    deep pages should use ``records_after``."""
    page, size = max(1, page), max(1, page_size)
    return (records_of(records, source).orderBy(*[F.desc(c) for c in NEWEST])
            .offset((page - 1) * size).limit(size))


def records_after(records: DataFrame, after: tuple | Row, page_size: int = K.PAGE_SIZE,
                  source: str | None = None) -> DataFrame:
    """R1 for deep pages: the page behind the last row (ingested_at, record_hash)
    of the page before; the filter reaches the scan and the top-k stays one page."""
    at, digest = (F.lit(v).cast(t) for v, t in zip(after, ("timestamp", "string")))
    below = (F.col("ingested_at") < at) | ((F.col("ingested_at") == at)
                                           & (F.col("record_hash") < digest))
    return (records_of(records, source).filter(below)
            .orderBy(*[F.desc(c) for c in NEWEST]).limit(max(1, page_size)))


def page_counts(records: DataFrame, fine: int = 10_000) -> DataFrame:
    """Fence posts of the newest-first order: records per source and minute of arrival; where a minute
    has more than ``fine`` records that all arrived at one instant, also by the first two digits of
    the fingerprint (else null). Counts of parts of the records add up."""
    minute = F.date_trunc("minute", "ingested_at")
    by_digits = records.groupBy("source", minute.alias("minute"), F.substring("record_hash", 1, 2).alias("digits")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("ingested_at").alias("low"), F.max("ingested_at").alias("high"))
    of = W.partitionBy("source", "minute")
    dense = (F.sum("rows").over(of) > fine) & (F.min("low").over(of) == F.max("high").over(of))
    return (by_digits.withColumn("digits", F.when(dense, F.col("digits"))).groupBy("source", "minute", "digits")
            .agg(F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high")))


def _window(fences: list[Row], skip: int, take: int) -> tuple[list[Row], int]:
    """Of fences in reading order, those that rows skip ... skip + take lie in, and how many rows to
    skip in them."""
    chosen, before, first = [], 0, 0
    for fence in fences:
        if before + fence["rows"] > skip and before < skip + take:
            if not chosen:
                first = before
            chosen.append(fence)
        before += fence["rows"]
    return chosen, skip - first


def records_page_at(records: DataFrame, counts: DataFrame, page: int = 1, page_size: int = K.PAGE_SIZE,
                    source: str | None = None) -> DataFrame:
    """The page that records_page() gives, from the stretch of rows it lies in: page_counts() of the
    records say which minutes (days first), and inside one crowded instant which fingerprints,
    hold it, and these bounds reach the scan. What is sorted is the stretch, not all rows before."""
    page, size = max(1, page), max(1, page_size)
    skip = (page - 1) * size
    held = counts if source is None else counts.filter(F.col("source") == source)
    rows = records_of(records, source)
    for unit in ("day", "minute"):
        key = F.date_trunc(unit, "minute").alias("key")
        # Days are few; minutes are those of the days that the page lies in.
        fences = held.groupBy(key).agg(F.sum("rows").alias("rows"), F.min("low").alias("low"),
                                       F.max("high").alias("high")).orderBy(F.desc("key")).collect()
        chosen, skip = _window(fences, skip, size)
        if not chosen:
            return rows.limit(0)
        last, first = chosen[-1]["low"], chosen[0]["high"]
        held = held.filter(F.col("minute").between(F.date_trunc("minute", F.lit(last)), F.lit(first)))
    bounds = F.col("ingested_at").between(F.lit(last), F.lit(first))
    if last == first:
        fences = (held.groupBy("digits").agg(F.sum("rows").alias("rows")).orderBy(F.desc("digits")).collect())
        if all(f["digits"] is not None for f in fences):
            chosen, skip = _window(fences, skip, size)
            low, high = chosen[-1]["digits"], chosen[0]["digits"]
            bounds = bounds & (F.col("record_hash") >= low) & (F.col("record_hash") < high + "~")
    return rows.filter(bounds).orderBy(*[F.desc(c) for c in NEWEST]).offset(skip).limit(size)


def records_total(records: DataFrame, source: str | None = None) -> DataFrame:
    """Size of the filtered set."""
    return records_of(records, source).agg(F.count(F.lit(1)).alias("total"))


def page_numbers(total: DataFrame, page: int = 1, page_size: int = K.PAGE_SIZE) -> DataFrame:
    """Number of pages (at least one) and the range a page shows."""
    page, size = max(1, page), max(1, page_size)
    return total.select(
        F.lit(page).alias("page"), F.lit(size).alias("page_size"), "total",
        F.greatest(F.lit(1), F.ceil(F.col("total") / size)).cast("bigint").alias("total_pages"),
        F.lit((page - 1) * size + 1).cast("bigint").alias("range_start"),
        F.least(F.col("total"), F.lit(page * size)).cast("bigint").alias("range_end"))


def recent_runs(runs: DataFrame, limit: int = K.RECENT_RUNS) -> DataFrame:
    """R2: newest runs first."""
    return runs.orderBy(F.desc("run_id")).limit(limit)


def by_id(rows: DataFrame, value: int | str, column: str = "id") -> DataFrame:
    """Point lookup; an unknown id gives no rows."""
    return rows.filter(F.col(column) == value)


def latest_snapshot(snapshots: DataFrame, time: str = "timestamp") -> DataFrame:
    """The newest snapshot, as a top-1."""
    order = [F.desc(time)] + ([F.desc("run_id")] if "run_id" in snapshots.columns else [])
    return snapshots.orderBy(*order).limit(1)


def quality_trend(snapshots: DataFrame, limit: int = K.TREND_POINTS) -> DataFrame:
    """The newest ``limit`` snapshots, oldest first; a snapshot without a run gets
    its place in the list. A limit below 1 raises ValueError."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    order = ["timestamp", F.coalesce("run_id", F.lit(0))]
    place = F.row_number().over(W.orderBy(*order)).cast("bigint")
    newest = snapshots.orderBy(F.desc("timestamp"), F.desc(order[1])).limit(limit)
    return (newest.withColumn("point", place)
            .withColumn("run_id", F.coalesce("run_id", "point"))
            .select("point", "run_id", "timestamp", "overall_score", *K.QUALITY_WEIGHTS)
            .orderBy("point"))


def anomalies_list(anomalies: DataFrame, source: str | None = None,
                   severity: str | None = None) -> DataFrame:
    """Filtered anomalies, newest first (a total order: ties by id)."""
    return items_where(anomalies, source=source, severity=severity).orderBy(
        F.desc("timestamp"), "id")


def alerts_list(alerts: DataFrame, status: str | None = None) -> DataFrame:
    """Filtered alerts, newest first; ALL means no filter."""
    return items_where(alerts, status=None if status == "ALL" else status).orderBy(
        F.desc("timestamp"), "id")


def duration_series(runs: DataFrame, limit: int = K.CHART_RUNS) -> DataFrame:
    """Durations of the newest runs, oldest first, in whole milliseconds."""
    rounded = F.floor(F.col("duration_ms") + 0.5).cast("bigint")
    return (runs.orderBy(F.desc("run_id")).limit(limit)
            .select("run_id", fill("Run %d", F.col("run_id")).alias("label"),
                    rounded.alias("duration_ms"), "status").orderBy("run_id"))


def source_lanes(lanes: DataFrame, sources: DataFrame) -> DataFrame:
    """Every lane with its source's status, UNKNOWN when there is none."""
    return (lanes.join(sources.select(F.col("source").alias("name"), "status"), "name", "left")
            .select("name", F.coalesce("status", F.lit("UNKNOWN")).alias("health")))


def default_lanes(anchor: DataFrame) -> DataFrame:
    """The fixed list of lanes as a DataFrame in the session of ``anchor``."""
    names: Column = F.array(*[F.lit(n) for n in K.SOURCE_LANES])
    return anchor.sparkSession.range(1).select(F.explode(names).alias("name"))
