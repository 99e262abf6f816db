"""Schema detection and mapping onto the canonical record."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace import contract as K
from millrace.functions.asof import AsOf, as_instant
from millrace.functions.instants import parse_instant
from millrace.functions.text import strip, to_number

CANONICAL_COLUMNS = ["record_id", "name", "email", "value", "source", "created_at",
                     "ingested_at", "source_rank", "pos"]
TARGETS = ["record_id", "name", "email", "value", "created_at"]
_NUMERIC = {"double", "float", "int", "bigint", "smallint", "tinyint"}
_INSTANT = {"timestamp", "timestamp_ntz", "date"}


def _typed(raw: DataFrame, name: str, target: str) -> bool:
    """Numbers and instants that are already typed need no parsing."""
    kind = raw.schema[name].dataType.simpleString()
    if target == "value":
        return kind in _NUMERIC or kind.startswith("decimal")
    return target == "created_at" and kind in _INSTANT


def _canonical(stripped: DataFrame, source: Column, rank: Column, as_of: AsOf,
               typed: set[str]) -> DataFrame:
    """P2-P7 over columns ``_record_id`` ... ``_created_at`` of stripped text.

    Stripping is a projection of its own: the texts are used several times below,
    so Spark keeps the projection and strips each of them once.
    """
    text = {t: F.nullif(F.col(f"_{t}"), F.lit("")) for t in ("record_id", "name", "email")}
    value = F.col("_value").cast("double") if "value" in typed else to_number("_value", True)
    created = (F.col("_created_at").cast("timestamp") if "created_at" in typed
               else parse_instant("_created_at", True))
    return stripped.select(
        F.coalesce(text["record_id"], F.lit("")).alias("record_id"), text["name"].alias("name"),
        F.lower(text["email"]).alias("email"), value.alias("value"), source.alias("source"),
        created.alias("created_at"), as_instant(as_of).alias("ingested_at"),
        rank.cast("int").alias("source_rank"), F.col("pos").cast("bigint").alias("pos"))


def normalize_feed(raw: DataFrame, source: str, rank: int, *, as_of: AsOf = None,
                   pos: str = "pos", fields: Mapping[str, str] | None = None) -> DataFrame:
    """P6a-c, P7: one typed feed onto the canonical columns.

    ``fields`` maps canonical names to feed columns; the three known feeds have
    theirs built in. A feed without one of the columns gets null there.
    """
    names = {t: c for t, c in (fields or K.FEED_FIELDS[source]).items() if c in raw.columns}
    typed = {t for t, c in names.items() if _typed(raw, c, t)}
    texts = {f"_{t}": F.lit(None).cast("string") if t not in names
             else F.col(names[t]) if t in typed else strip(names[t]) for t in TARGETS}
    stripped = raw.select(*[c.alias(n) for n, c in texts.items()], F.col(pos).alias("pos"))
    return _canonical(stripped, F.lit(source), F.lit(rank), as_of, typed)


def detect_source(keys: Column) -> Column:
    """Feed name by which id field is present (even when its value is null)."""
    chain = F
    for source, names in K.FEED_FIELDS.items():
        chain = chain.when(F.array_contains(keys, names["record_id"]), F.lit(source))
    return chain.otherwise(F.lit(K.UNKNOWN_SOURCE))


def detect_schema(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """P1 over a column of JSON objects; adds ``source``."""
    return raw.withColumn("source", detect_source(F.json_object_keys(payload)))


def normalize_mixed(raw: DataFrame, rank: int | str = 1, *, payload: str = "payload",
                    as_of: AsOf = None, pos: str = "pos") -> DataFrame:
    """P1, P6, P7 over JSON objects of any of the known schemas, or of none.

    The payload is parsed once into a map. A row of an unknown schema is kept,
    with nothing but its id, so that validation rejects it visibly.
    """
    parsed = raw.select(
        F.from_json(payload, "map<string,string>").alias("_m"), F.col(pos).alias("pos"),
        (F.lit(rank) if isinstance(rank, int) else F.col(rank)).alias("source_rank"),
    ).withColumn("source", F.coalesce(detect_source(F.map_keys("_m")),
                                      F.lit(K.UNKNOWN_SOURCE)))

    def field(target: str) -> Column:
        chain = F
        for source, names in K.FEED_FIELDS.items():
            chain = chain.when(F.col("source") == source,
                               F.try_element_at("_m", F.lit(names[target])))
        if target != "record_id":
            return chain.otherwise(F.lit(None))
        return chain.otherwise(F.try_element_at("_m", F.lit("record_id")))

    stripped = parsed.select(*[strip(field(t)).alias(f"_{t}") for t in TARGETS],
                             "source", "source_rank", "pos")
    return _canonical(stripped, F.col("source"), F.col("source_rank"), as_of, set())


def passthrough(raw: DataFrame, rank: int = 1, *, as_of: AsOf = None,
                pos: str = "pos") -> DataFrame:
    """Best-effort mapping of rows that already carry canonical names.

    The id is ``id``, else ``record_id``, else ``unknown-`` and the position in
    the batch; the source is ``source`` or ``unknown``. Nothing is cleaned.
    """
    have = set(raw.columns)

    def pick(name: str, kind: str) -> Column:
        column = F.col(name) if name in have else F.lit(None)
        return column.try_cast(kind) if kind != "string" else column.cast(kind)

    return raw.select(
        F.coalesce(pick("id", "string"), pick("record_id", "string"),
                   F.concat(F.lit("unknown-"), F.col(pos).cast("string"))).alias("record_id"),
        pick("name", "string").alias("name"), pick("email", "string").alias("email"),
        pick("value", "double").alias("value"),
        F.coalesce(pick("source", "string"), F.lit("unknown")).alias("source"),
        pick("created_at", "timestamp").alias("created_at"),
        as_instant(as_of).alias("ingested_at"),
        F.lit(rank).cast("int").alias("source_rank"), F.col(pos).cast("bigint").alias("pos"),
    )


def union_feeds(feeds: Iterable[DataFrame]) -> DataFrame:
    """All normalised feeds as one batch; order is carried in
    ``source_rank`` and ``pos``, not in the row order of the union."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), list(feeds))
