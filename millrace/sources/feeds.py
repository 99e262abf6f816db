"""Source specifications and file feeds."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from millrace import contract as K, schemas
from millrace.functions.asof import AsOf
from millrace.operators.normalize import normalize_feed, normalize_mixed

CORRUPT = "_corrupt_record"
TEXT_FORMATS = ("json", "csv", "text")
# Arrival order of rows from files: the file's path, where its split begins, the row in it.
FILE, SPLIT = "_feed_file", "_feed_split"


@dataclass(frozen=True)
class SourceSpec:
    """One source of a run.

    ``read`` builds a DataFrame of raw rows and may raise. ``rank`` is the place
    of the source in the batch: of two equal records the one of the lower rank
    wins. ``position`` names the column with the arrival order inside the source;
    without it rows of files are ordered by path and place in the file, and other rows by
    the scan order when the raw rows are written. ``stored`` is a folder of raw rows
    that an earlier run wrote: they are read from there and not written again.
    ``normalize`` maps raw rows with ``pos`` to canonical rows; the known feeds and
    JSON payload feeds have a default.
    """

    name: str
    rank: int
    read: Callable[[SparkSession], DataFrame]
    position: str | None = None
    normalize: Callable[[DataFrame, AsOf], DataFrame] | None = None
    stored: str | None = None

    def raw(self, spark: SparkSession) -> DataFrame:
        """Raw rows with their position in the source."""
        rows = self.read(spark)
        if self.position:
            return rows.drop(FILE, SPLIT).withColumn("pos", F.col(self.position).cast("bigint"))
        return rows.withColumn("pos", F.monotonically_increasing_id())

    def canonical(self, raw: DataFrame, as_of: AsOf = None) -> DataFrame:
        raw = in_file_order(raw)
        if self.normalize is not None:
            return self.normalize(raw, as_of)
        if self.name in K.FEED_FIELDS:
            return normalize_feed(raw, self.name, self.rank, as_of=as_of)
        return normalize_mixed(raw, self.rank, as_of=as_of)


def read_feed(spark: SparkSession, path: str | list[str], fmt: str, schema: T.StructType | None,
              options: Mapping[str, str] | None = None) -> DataFrame:
    """A feed with an explicit schema. Rows that do not parse keep their text in
    ``_corrupt_record`` and are rejected later instead of stopping the load."""
    reader = spark.read.options(**(options or {}))
    place = (F.col("_metadata.file_path").alias(FILE),
             F.col("_metadata.file_block_start").alias(SPLIT))
    if schema is None:
        return reader.format(fmt).load(path).select("*", *place)
    if fmt in ("json", "csv"):
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        if fmt == "csv" and "header" not in (options or {}):
            reader = reader.option("header", "true")
    return reader.schema(schema).format(fmt).load(path).select("*", *place)


def in_file_order(raw: DataFrame) -> DataFrame:
    """``pos`` as the place of a row in all files of its feed, where the raw rows have
    their file: how Spark packed files into tasks when it read them has no influence.
    One row per file split is ordered; the rows are not."""
    if FILE not in raw.columns:
        return raw
    splits = (raw.select(FILE, SPLIT).distinct()
              .withColumn("_n", F.row_number().over(W.orderBy(FILE, SPLIT)).cast("bigint")))
    inside = F.col("pos").bitwiseAND(F.lit((1 << 33) - 1))
    return (raw.join(splits, [FILE, SPLIT])
            .withColumn("pos", F.shiftleft("_n", 33).bitwiseOR(inside)).drop("_n", FILE, SPLIT))


def file_source(name: str, rank: int, path: str | list[str], fmt: str = "json",
                schema: T.StructType | None = None, position: str | None = None,
                options: Mapping[str, str] | None = None) -> SourceSpec:
    """A source read from JSON lines, CSV, Parquet or ORC files. Known feeds in JSON or CSV are
    read as text; typed formats bring their own schema."""
    wanted = schema or (schemas.RAW[name] if fmt in TEXT_FORMATS else None)
    return SourceSpec(name, rank, lambda spark: read_feed(spark, path, fmt, wanted, options),
                      position)


def payload_source(name: str, rank: int, path: str | list[str]) -> SourceSpec:
    """A source of JSON objects of mixed or unknown schemas, one per line."""
    return SourceSpec(name, rank, lambda spark: read_feed(
        spark, path, "text", T.StructType([T.StructField("value", T.StringType())]))
                      .withColumnRenamed("value", "payload"),
                      normalize=lambda raw, at: normalize_mixed(raw, rank, as_of=at))


def jdbc_source(name: str, rank: int, options: Mapping[str, str],
                position: str | None = None) -> SourceSpec:
    """A source read from a database table with Spark's JDBC options; give
    partitionColumn, lowerBound, upperBound and numPartitions for a parallel read."""
    return SourceSpec(name, rank,
                      lambda spark: spark.read.format("jdbc").options(**options).load(), position)


def frame_source(name: str, rank: int, frame: DataFrame, position: str | None = None,
                 normalize: Callable[[DataFrame, AsOf], DataFrame] | None = None) -> SourceSpec:
    """A source that is already a DataFrame (a table, a query)."""
    return SourceSpec(name, rank, lambda _: frame, position, normalize)


def stored_source(name: str, rank: int, folder: str,
                  normalize: Callable[[DataFrame, AsOf], DataFrame] | None = None) -> SourceSpec:
    """The raw rows that an earlier run stored of a source."""
    return SourceSpec(name, rank, lambda spark: spark.read.parquet(folder), "pos", normalize, folder)
