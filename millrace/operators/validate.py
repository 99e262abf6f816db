"""Validation of canonical rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.rules import error_list, passes_all


# Never parsed, so filters on them may move through the rules.
BESIDE = ("source", "source_rank", "pos", "run_id")


def with_errors(canonical: DataFrame) -> DataFrame:
    """V1-V7: adds ``errors``, the messages that apply, in rule order."""
    return canonical.withColumn("errors", error_list())


def _only(rows: DataFrame, wanted: Column) -> DataFrame:
    """Rows for which ``wanted`` holds, by a generator instead of a filter.

    Spark moves a filter below the projection that made its columns, writing their
    expressions out in the condition: every text would be parsed once for each time a
    rule mentions it, and again for the result. A generator stays above the
    projection, so each row is parsed once. Columns that cost nothing to make pass
    beside it: a filter on the source goes on down and leaves other feeds unread.
    """
    beside = [c for c in BESIDE if c in rows.columns]
    made = [c for c in rows.columns if c not in BESIDE]
    return (rows.select(*beside, F.inline(F.when(wanted, F.array(F.struct(*made)))))
            .select(*rows.columns))


def valid_records(canonical: DataFrame) -> DataFrame:
    """V8: rows that break no rule."""
    return _only(canonical, passes_all())


def rejected_records(canonical: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """V8: rows that break a rule, with the reasons."""
    columns = [*keep, "source", "source_rank", "pos", "record_id", "errors"]
    return _only(with_errors(canonical).select(*columns), F.size("errors") > 0)


def validation_counts(canonical: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """V9: totals, optionally per source or run; combines before any shuffle."""
    return canonical.groupBy(*by).agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(passes_all()).alias("valid_count"),
        F.count_if(~passes_all()).alias("invalid_count"),
    )


def reject_reasons(canonical: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """V9: how often each reason occurs; a row counts once per reason."""
    return (rejected_records(canonical, keep=tuple(c for c in by if c != "source"))
            .select(*by, F.explode("errors").alias("reason"))
            .groupBy(*by, "reason").agg(F.count(F.lit(1)).alias("rows")))


def require_hash(records: DataFrame, column: str = "record_hash") -> DataFrame:
    """Fail the write when a row has no fingerprint."""
    missing = F.col(column).isNull() | (F.col(column) == "")
    return records.withColumn(column, F.when(missing, F.raise_error(F.concat(
        F.lit("record without "), F.lit(column), F.lit(" refused: "),
        F.coalesce(F.col("record_id") if "record_id" in records.columns
                   else F.col("source_record_id"), F.lit("?"))))
    ).otherwise(F.col(column)))


def records_of(records: DataFrame, source: str | None = None) -> DataFrame:
    """Records of one source. Only None means no filter; an empty name is a name."""
    return records if source is None else records.filter(F.col("source") == source)


def items_where(items: DataFrame, **equals: str | None) -> DataFrame:
    """Equality filters on anomalies and alerts; None and '' mean no filter."""
    for column, wanted in equals.items():
        if wanted:
            items = items.filter(F.col(column) == wanted)
    return items
