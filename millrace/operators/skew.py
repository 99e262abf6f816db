"""Joins of rows whose key may be very frequent to one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# At most this many keys are broadcast: about 130 bytes each, so under 3 MB.
HOT_KEYS = 20_000
HOT_COPIES = 10_000


def join_per_key(rows: DataFrame, keyed: DataFrame, on: str, copies: str = "copies",
                 spread: tuple[str, ...] = ("pos",), hot_keys: int = HOT_KEYS,
                 hot_copies: int = HOT_COPIES) -> DataFrame:
    """Inner join of ``rows`` to ``keyed``, which has one row per key and says in
    ``copies`` how many rows share it; ``on`` is a text column.

    The most frequent keys (at most ``hot_keys`` of them, and only those with
    ``hot_copies`` rows or more) are broadcast; that limit bounds the size. Rows that
    found their key this way take part in the shuffle join for all others under a
    salt made of the ``spread`` columns, which matches nothing, so they are dealt out
    evenly. A key that does meet its rows in the shuffle has fewer than
    1/``hot_keys`` of all rows. ``rows`` is read once, and no row is lost.
    """
    hot = (keyed.filter(F.col(copies) >= hot_copies)
           .orderBy(F.desc(copies), on).limit(hot_keys))
    rest = [c for c in keyed.columns if c != on]
    marked = rows.join(F.broadcast(hot.select(on, F.struct(*rest).alias("_hot"))), on, "left")
    salt = F.concat(F.lit("#"), F.xxhash64(*spread).cast("string"))
    cold = keyed.select(F.col(on).alias("_key"), F.struct(*rest).alias("_cold"))
    joined = (marked.withColumn("_key", F.when(F.col("_hot").isNull(), F.col(on)).otherwise(salt))
              .join(cold, "_key", "left"))
    found = F.coalesce("_hot", "_cold")
    return (joined.withColumn("_found", found).filter(F.col("_found").isNotNull())
            .select(*rows.columns, "_found.*"))
