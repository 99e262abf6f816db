"""Data-quality scores (Q1-Q10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace import contract as K
from millrace.functions.asof import AsOf, as_instant
from millrace.functions.instants import parse_iso
from millrace.functions.render import round_even


def _missing(records: DataFrame, name: str) -> Column:
    """Null, NaN and '' are missing; a column that is not there always is."""
    if name not in records.columns:
        return F.lit(True)
    col = F.col(name)
    kind = records.schema[name].dataType.simpleString()
    if kind in ("double", "float"):
        return col.isNull() | F.isnan(col)
    if kind == "string":
        return col.isNull() | (col == "")
    return col.isNull()


def _arrival(records: DataFrame) -> tuple[Column, Column]:
    """Arrival time of a row, and whether it is text that is no time."""
    if "ingested_at" not in records.columns:
        return F.lit(None).cast("timestamp"), F.lit(False)
    if records.schema["ingested_at"].dataType.simpleString() != "string":
        return F.col("ingested_at").cast("timestamp"), F.lit(False)
    at = parse_iso("ingested_at")
    return at, F.col("ingested_at").isNotNull() & at.isNull()


def quality_counters(records: DataFrame) -> list[Column]:
    """The sums behind every score, as aggregates."""
    missing = {c: _missing(records, c) for c in K.QUALITY_FIELDS}
    text = F.coalesce(F.col("email"), F.lit("")) if "email" in records.columns else F.lit("")
    value = F.col("value") if "value" in records.columns else F.lit(None).cast("double")
    valid = (text.contains("@") & text.contains(".")
             & value.isNotNull() & ~F.coalesce(value < 0, F.lit(False)))
    consistent = (text == F.lower(text)) & ~missing["created_at"]
    arrived, unreadable = _arrival(records)
    return [F.count(F.lit(1)).alias("rows"),
            *[F.count_if(cond).alias(f"missing_{name}") for name, cond in missing.items()],
            F.count_if(valid).alias("valid_rows"),
            F.count_if(consistent).alias("consistent_rows"),
            F.max(arrived).alias("newest_ingested_at"),
            F.count_if(unreadable).alias("unreadable_rows")]


SUMMED = ["rows", "missing_name", "missing_email", "missing_value", "missing_created_at",
         "valid_rows", "consistent_rows", "unreadable_rows"]


def quality_profile(records: DataFrame, by: Sequence[str] = ("source",)) -> DataFrame:
    """The additive counters behind every score, one row per group. One scan; tasks
    send one row per group, so a source with most of the rows costs nothing extra."""
    return records.groupBy(*by).agg(*quality_counters(records))


def _percent(part: Column, whole: Column) -> Column:
    return part / whole * 100.0


def _clamp(low: float, value: Column, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def _scores(as_of: AsOf) -> dict[str, Column]:
    """Q1-Q5 over summed counters and ``unique_rows`` (null: no hash column)."""
    n = F.col("rows")
    cells = n * len(K.QUALITY_FIELDS)
    gaps = sum((F.col(f"missing_{c}") for c in K.QUALITY_FIELDS), F.lit(0))
    hours = (as_instant(as_of).cast("double") - F.col("newest_ingested_at").cast("double")) / 3600
    fresh = _clamp(50.0, 100.0 - F.least(hours * 2.0, F.lit(50.0)), 100.0)
    scores = {
        "completeness": _clamp(0.0, _percent(cells - gaps, cells), 100.0),
        "validity": _percent(F.col("valid_rows"), n),
        "consistency": _percent(F.col("consistent_rows"), n),
        "uniqueness": F.coalesce(_percent(F.col("unique_rows"), n), F.lit(100.0)),
        # The clamp itself would turn an unknown age into the lowest score.
        "freshness": F.when(F.col("unreadable_rows") > 0, K.FRESHNESS_UNREADABLE)
        .when(F.col("newest_ingested_at").isNotNull(), fresh).otherwise(K.FRESHNESS_DEFAULT),
    }
    return {name: F.when(n == 0, 100.0).otherwise(score) for name, score in scores.items()}


def _with_scores(counted: DataFrame, as_of: AsOf, keep: Sequence[str]) -> DataFrame:
    scores = _scores(as_of)
    raw = counted.select(*keep, "rows", "valid_rows", "consistent_rows",
                         *[col.alias(name) for name, col in scores.items()])
    overall = sum((F.col(c) * w for c, w in K.QUALITY_WEIGHTS.items()), F.lit(0.0))
    return raw.select(*keep, round_even(overall, 1).alias("overall_score"),
                      *[round_even(F.col(c), 1).alias(c) for c in scores],
                      "rows", "valid_rows", "consistent_rows")


def quality_scores(records: DataFrame, as_of: AsOf = None, limit: int | None = None) -> DataFrame:
    """Q1-Q6, Q8-Q10: one row of scores over the whole table.

    The additive counters and the distinct fingerprints are separate aggregates
    over their own columns: counted together, every row's counters would travel
    with its fingerprint through the distinct shuffle. ``limit`` takes the newest
    rows only, as an option.
    """
    records = newest_records(records, limit)
    counted = _sum_profile(quality_profile(records, ()), records)
    return _with_scores(counted, as_of, ())


def _sum_profile(profile: DataFrame, records: DataFrame) -> DataFrame:
    if "record_hash" not in records.columns:
        return profile.withColumn("unique_rows", F.lit(None).cast("bigint"))
    unique = records.agg(F.count_distinct("record_hash")).scalar()
    return profile.withColumn("unique_rows", unique)


def newest_records(records: DataFrame, limit: int | None) -> DataFrame:
    """Q10: the newest rows when a limit is asked for, else all."""
    if limit is None:
        return records
    return records.orderBy(F.desc("ingested_at"), F.desc("record_hash")).limit(limit)


def quality_by_group(records: DataFrame, by: Sequence[str], as_of: AsOf = None) -> DataFrame:
    """Q1-Q6 per group (run, day ...) in one aggregate."""
    counters = [*quality_counters(records)]
    if "record_hash" in records.columns:
        counters.append(F.count_distinct("record_hash").alias("unique_rows"))
    counted = records.groupBy(*by).agg(*counters)
    if "unique_rows" not in counted.columns:
        counted = counted.withColumn("unique_rows", F.lit(None).cast("bigint"))
    return _with_scores(counted, as_of, by)


def _source_completeness() -> Column:
    fields = K.QUALITY_SOURCE_FIELDS
    cells = F.col("rows") * len(fields)
    gaps = sum((F.col(f"missing_{c}") for c in fields), F.lit(0))
    return round_even(_percent(cells - gaps, cells), 1)


def quality_by_source(records: DataFrame) -> DataFrame:
    """Q7: completeness of each named source."""
    return (quality_profile(records.filter(F.col("source").isNotNull()))
            .select("source", "rows", _source_completeness().alias("completeness")))


def quality_snapshot(records: DataFrame, run_id: int | None = None, as_of: AsOf = None,
                     limit: int | None = None) -> DataFrame:
    """Q1-Q10 as one row of ``quality_metrics``.

    One scan counts per source; the per-source rows are summed for the overall
    scores and folded into the map, and fingerprints are counted beside it.
    """
    records = newest_records(records, limit)
    unique = (records.agg(F.count_distinct("record_hash")).scalar()
              if "record_hash" in records.columns else F.lit(None).cast("bigint"))
    return snapshot_of(quality_profile(records), unique, run_id, as_of)


def snapshot_of(profile: DataFrame, unique: Column | None = None, run_id: int | None = None,
                as_of: AsOf = None) -> DataFrame:
    """quality_snapshot() from counters per source (several rows of a source add up).
    ``unique`` is the number of different fingerprints; None where no two rows share one."""
    profile = profile.groupBy("source").agg(
        *[F.sum(c).alias(c) for c in SUMMED],
        F.max("newest_ingested_at").alias("newest_ingested_at"))
    by_source = F.map_from_entries(F.array_sort(F.collect_list(F.when(
        F.col("source").isNotNull(), F.struct("source", _source_completeness())))))
    counted = profile.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMMED],
        F.max("newest_ingested_at").alias("newest_ingested_at"),
        by_source.alias("quality_by_source"))
    counted = counted.withColumn("unique_rows", F.col("rows") if unique is None else unique)
    scored = _with_scores(counted, as_of, ("quality_by_source",))
    counts = F.create_map(
        F.lit("total_records_evaluated"), F.col("rows").cast("string"),
        F.lit("valid_records_count"), F.col("valid_rows").cast("string"),
        F.lit("consistent_records_count"), F.col("consistent_rows").cast("string"))
    empty = F.create_map(F.lit("message"), F.lit(K.EMPTY_QUALITY_MESSAGE))
    return scored.select(
        F.lit(run_id).cast("bigint").alias("run_id"), "overall_score", *K.QUALITY_WEIGHTS,
        "quality_by_source", F.when(F.col("rows") == 0, empty).otherwise(counts).alias("details"),
        as_instant(as_of).alias("timestamp"))
