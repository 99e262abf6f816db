"""First-wins deduplication (D1-D5) and the fingerprint column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from millrace.functions.identity import fingerprint
from millrace.operators.skew import HOT_COPIES, HOT_KEYS, join_per_key

ARRIVAL = ("source_rank", "pos")


def with_fingerprint(records: DataFrame) -> DataFrame:
    """Adds ``record_hash``."""
    return records.withColumn("record_hash", fingerprint())


def first_occurrences(records: DataFrame, keys: Sequence[str] = ("record_hash",),
                      order: Sequence[str] = ARRIVAL) -> DataFrame:
    """The first row of every key in arrival order.

    ``rn = 1`` directly above the window lets Spark keep one row per key in each
    input partition before it shuffles, so a key with a third of all rows sends
    one row per partition.
    """
    return (records
            .withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
            .filter(F.col("_rn") == 1).drop("_rn"))


def duplicate_pairs(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How many duplicates each (original, duplicate) source pair has.

    Rows are counted per key and source first (combined before the shuffle); what
    is ordered per key afterwards is one row per source, however many copies exist.
    """
    key = [*by, "record_hash"]
    per_source = records.groupBy(*key, "source_rank", "source").agg(
        F.count(F.lit(1)).alias("_n"), F.min("pos").alias("_pos"))
    original = F.first_value("source").over(W.partitionBy(*key).orderBy("source_rank", "_pos"))
    place = F.row_number().over(W.partitionBy(*key).orderBy("source_rank", "_pos"))
    return (per_source.withColumn("original_source", original).withColumn("_place", place)
            .withColumn("_extra", F.col("_n") - F.when(F.col("_place") == 1, 1).otherwise(0))
            .filter(F.col("_extra") > 0)
            .groupBy(*by, "original_source", F.col("source").alias("duplicate_source"))
            .agg(F.sum("_extra").alias("duplicates")))


def duplicate_count(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """D3: duplicates = rows minus distinct keys. The distinct count groups by key
    first, so neither a frequent key nor a large run lands in one task."""
    return records.groupBy(*by).agg(
        F.count(F.lit(1)).alias("valid_records"),
        F.count_distinct("record_hash").alias("unique_records"),
    ).withColumn("duplicates", F.col("valid_records") - F.col("unique_records"))


def _first_of_keys(records: DataFrame) -> DataFrame:
    """(record_hash, _first, _copies): the first row's arrival and source, and the rows of every key.

    Rows are counted per key and source first: numbers combine in a hash table before the
    shuffle, while the least of structs would sort all rows. A row without ``pos`` comes first.
    """
    per_source = records.groupBy("record_hash", "source_rank", "source").agg(
        F.min("pos").alias("pos"), F.max(F.col("pos").isNull()).alias("_unplaced"),
        F.count(F.lit(1)).alias("_n"))
    place = F.when(~F.col("_unplaced"), F.col("pos")).alias("pos")
    return per_source.groupBy("record_hash").agg(
        F.min(F.struct("source_rank", place, "source")).alias("_first"), F.sum("_n").alias("_copies"))


def duplicate_report(records: DataFrame, keep: Sequence[str] = (), hot_keys: int = HOT_KEYS,
                     hot_copies: int = HOT_COPIES) -> DataFrame:
    """One row per dropped duplicate with the source of the row that was kept.

    Keys with a single row never reach the join; see ``join_per_key`` for how
    keys with very many copies are handled.
    """
    keyed = _first_of_keys(records).filter(F.col("_copies") > 1)
    rows = records.select(*keep, "record_hash", "record_id", *ARRIVAL,
                          F.col("source").alias("duplicate_source"))
    joined = join_per_key(rows, keyed, "record_hash", "_copies", ARRIVAL, hot_keys, hot_copies)
    is_first = ((F.col("source_rank") == F.col("_first.source_rank"))
                & (F.col("pos") == F.col("_first.pos")))
    return joined.filter(~is_first).select(
        *keep, "record_hash", F.col("_first.source").alias("original_source"),
        "duplicate_source", "record_id", *ARRIVAL)


def new_records(batch: DataFrame, stored: DataFrame, key: str = "record_hash",
                order: Sequence[str] = ARRIVAL) -> DataFrame:
    """First occurrences of the batch that the store does not have yet.

    Only the key column of the store is read. Both sides hold each key once, so
    no key is frequent; a store bucketed by the key is not shuffled.
    """
    return (first_occurrences(batch, (key,), order)
            .join(stored.select(key), key, "left_anti"))
