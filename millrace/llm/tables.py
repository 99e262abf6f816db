"""Steps shared by the operators: written intermediate tables and gapless numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.session import shared_folder


def staged(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared folder and read again: its lineage ends there,
    so a lost executor repeats no earlier step, and several readers compute it once."""
    spark = frame.sparkSession
    path = shared_folder(spark, purpose)
    frame.write.mode("overwrite").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def documents(frame: DataFrame, *columns: str) -> DataFrame:
    """doc_id and text with fixed types; other columns, whatever their names, are left out."""
    return frame.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *columns)


def numbered(frame: DataFrame, key: str, order: list[str], name: str,
             per_part: int = 2_000) -> DataFrame:
    """``name``: 0, 1, 2, ... without gaps among the rows of each ``key``.

    Each key's rows are split by a hash of ``order`` into parts of about ``per_part`` rows; parts
    are numbered inside, and begin where the counts of the parts before them end. No
    task needs all rows of a key. The different keys must be few (shards, lengths up to
    a capacity): one row for each is broadcast.
    """
    sizes = frame.groupBy(key).agg(F.ceil(F.count("*") / per_part).alias("_parts"))
    cut = (frame.join(F.broadcast(sizes), key)
           .withColumn("_part", F.pmod(F.xxhash64(*order), F.col("_parts"))).drop("_parts"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (cut.groupBy(key, "_part").agg(F.count("*").alias("_rows"))
              .withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
              .drop("_rows"))
    inside = Window.partitionBy(key, "_part").orderBy(*order)
    return (cut.withColumn("_at", F.row_number().over(inside) - 1)
            .join(starts, [key, "_part"])
            .withColumn(name, (F.col("_start") + F.col("_at")).cast("long"))
            .drop("_part", "_at", "_start"))


FILTER_BITS = 24


def id_place(name: str) -> Column:
    """Where an id falls in the bit table of id_filter()."""
    return F.pmod(F.xxhash64(name), F.lit(1 << FILTER_BITS))


def id_filter(frame: DataFrame, name: str) -> np.ndarray:
    """Bit table (2 MB at any size) that passes every id of a column and, while it is not
    full, few others: rows that cannot take part in a later exact join stay where they are."""
    place = id_place(name)
    bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
    rows = (frame.select(place.alias("place")).withColumn("word", F.floor(F.col("place") / 64))
            .groupBy("word").agg(F.bit_or(bit).alias("bits")).toPandas())
    held = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    held[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return held


def passes(held: np.ndarray, place: pa.Array) -> np.ndarray:
    place = place.to_numpy(zero_copy_only=False)
    return ((held[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")
