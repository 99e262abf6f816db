"""Sharding by a k-d tree: recursive splits at weighted medians of the metadata.

Law: ``bytes``. A node that is to become k shards is split along its widest metadata dimension
(the one whose values span the largest share of their whole range) where the lower part holds
floor(k / 2) / k of the node's bytes, until every leaf is one shard of the target size. Rows
that agree in the dimension are split by doc_id and a hash of the row, so a value shared by a
third of all rows is divided like any other, and each split is right to half a document.

Medians are exact and distributed: all nodes of a level are searched at once by histograms of
``BINS`` bins that zoom in on the bin in which the weight is reached, first over the dimension,
then over doc_id, then over the hash. The driver sees histograms, never rows. The
small table of ids, sizes and dimensions is written once per level with each row's node. Slots are numbered in parts of a shard, so no task holds a shard.

Size: UTF-8 bytes of the text (null: none) plus 8. Rows with a null dimension come first in it,
rows with null doc_id before others. Rows that repeat exactly may stay together in a shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.tables import numbered, staged

BINS = 1024
OVERHEAD = 8
DIMENSIONS = ("by_lang", "by_source", "by_length")
LOWEST = -(1 << 62)


@dataclass
class Node:
    shards: int
    first: int  # number of its first shard
    keys: list[tuple[str, int]] | None = None  # the split: last (column, value) of the lower part


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, the dimensions and a hash of each row."""
    text = F.col("text").cast("string")
    have = set(docs.columns)
    # Half of the range of a long, so that differences stay inside it.
    half = F.shiftright(F.col("doc_id").cast("long"), 1)
    mixed = F.xxhash64("text", "doc_id", *[F.col(c) for c in ("lang", "source") if c in have])

    def coded(name: str) -> Column:
        return (F.crc32(F.col(name).cast("string")) if name in have else F.lit(None)).cast("long")

    return docs.select(
        F.col("doc_id").cast("long"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.coalesce(coded("lang"), F.lit(LOWEST)).alias("by_lang"),
        F.coalesce(coded("source"), F.lit(LOWEST)).alias("by_source"),
        F.coalesce(F.length(text).cast("long"), F.lit(LOWEST)).alias("by_length"),
        F.coalesce(half, F.lit(LOWEST)).alias("by_id"),
        F.shiftrightunsigned(mixed, 1).alias("by_row"))


def _by_node(values: list[int]) -> Column:
    """The value at the row's node."""
    return F.get(F.array(*[F.lit(v).cast("long") for v in values]), F.col("node"))


def _next_node(nodes: list[Node]) -> Column:
    """Number of a row's node one level further down."""
    chain, at = F.lit(0), 0
    for k, node in enumerate(nodes):
        value = F.lit(at)
        if node.keys:
            value = F.when(_upper(node.keys), F.lit(at + 1)).otherwise(F.lit(at))
        chain = F.when(F.col("node") == k, value).otherwise(chain)
        at += 2 if node.keys else 1
    return chain


def _upper(keys: list[tuple[str, int]]) -> Column:
    """Whether a row lies behind the split, by dimension, then doc_id, then hash."""
    (name, value), *rest = keys
    after = F.col(name) > F.lit(value)
    return after | ((F.col(name) == F.lit(value)) & _upper(rest)) if rest else after


def _widest(rows: DataFrame, count: int) -> list[str]:
    """For each node the dimension whose values span the largest share of their range."""
    names = DIMENSIONS
    ends = [f(c).cast("double").alias(f"{tag}_{c}") for c in names for tag, f in
            (("low", F.min), ("high", F.max))]
    # Nulls stand before everything: they count as the lowest value but do not stretch the range.
    rows = rows.select("node", *[F.when(F.col(c) != LOWEST, F.col(c)).alias(c) for c in names])
    whole = rows.agg(*ends).first()
    chosen = ["by_length"] * count
    for row in rows.groupBy("node").agg(*ends).collect():
        def share(c, row=row):
            span = (whole[f"high_{c}"] or 0) - (whole[f"low_{c}"] or 0)
            return ((row[f"high_{c}"] or 0) - (row[f"low_{c}"] or 0)) / span if span else 0.0
        chosen[row["node"]] = max(names, key=lambda c: (share(c), c))
    return chosen


def _reach(rows: DataFrame, column: Column, wanted: dict[int, int]
           ) -> dict[int, tuple[int, int, int]]:
    """For each node the least value at which the weight of rows up to it reaches ``wanted``,
    the weight below that value and the weight at it. All nodes zoom together."""
    rows = rows.select("node", "size", column.alias("v"))
    spans = rows.groupBy("node").agg(F.min("v").alias("low"), F.max("v").alias("high"),
                                     F.sum("size").alias("w")).collect()
    ends = {r["node"]: (r["low"], r["high"]) for r in spans}
    at = {r["node"]: r["w"] for r in spans}
    below = dict.fromkeys(ends, 0)
    while any(low < high for low, high in ends.values()):
        size = max(ends) + 1
        low, high, width = [0] * size, [-1] * size, [1] * size
        for node, (a, b) in ends.items():
            low[node], high[node], width[node] = a, b, max(1, -(-(b - a + 1) // BINS))
        bins = (rows.withColumns({"low": _by_node(low), "high": _by_node(high)})
                .filter("v >= low and v <= high").withColumn("width", _by_node(width))
                .groupBy("node", F.expr("cast((v - low) div width as int)").alias("bin"))
                .agg(F.sum("size").alias("w")).collect())
        per: dict[int, dict[int, int]] = {}
        for r in bins:
            per.setdefault(r["node"], {})[r["bin"]] = r["w"]
        for node, (a, b) in list(ends.items()):
            if a == b:
                continue
            step = max(1, -(-(b - a + 1) // BINS))
            for k in sorted(per[node]):
                if below[node] + per[node][k] >= wanted[node]:
                    break
                below[node] += per[node][k]
            at[node] = per[node][k]
            ends[node] = (a + k * step, min(b, a + (k + 1) * step - 1))
    return {node: (low, below[node], at[node]) for node, (low, _) in ends.items()}


def _splits(rows: DataFrame, level: list[Node]) -> dict[int, list[tuple[str, int]]]:
    """Where each node of the level that is more than one shard is split."""
    chosen = _widest(rows, len(level))
    dimension = F.lit(None).cast("long")
    for name in DIMENSIONS:
        dimension = F.when(_by_node([int(c == name) for c in chosen]) == 1,
                           F.col(name)).otherwise(dimension)
    parts = [node.shards for node in level]
    rows = rows.filter(_by_node(parts) > 1).withColumn("by_dimension", dimension)
    total = rows.groupBy("node").agg(F.sum("size").alias("w")).collect()
    wanted = {r["node"]: -(-r["w"] * (parts[r["node"]] // 2) // parts[r["node"]]) for r in total}
    keys: dict[int, list[tuple[str, int]]] = {k: [] for k in wanted}
    for name in ("by_dimension", "by_id", "by_row"):
        last = [0] * len(level)
        for k, (value, below, at) in _reach(rows, F.col(name), wanted).items():
            if name == "by_row" and at > 2 * (wanted[k] - below):
                value -= 1  # the row on the median is nearer to the upper part
            keys[k].append((chosen[k] if name == "by_dimension" else name, value))
            wanted[k] -= below
            last[k] = value
        rows = rows.filter(F.col(name) == _by_node(last))
    return keys


def build(rows: DataFrame, shards: int) -> tuple[DataFrame, list[Node]]:
    """(rows with their leaf as ``node``, leaves) of the tree over columns of measured()."""
    rows, level = rows.withColumn("node", F.lit(0)), [Node(shards, 0)]
    while any(node.shards > 1 for node in level):
        keys, after = _splits(rows, level), []
        for k, node in enumerate(level):
            if node.shards == 1:
                after.append(Node(1, node.first))
                continue
            half = node.shards // 2
            node.keys = keys.get(k, [("by_id", 0), ("by_row", 0)])  # no rows: any split
            after += [Node(half, node.first), Node(node.shards - half, node.first + half)]
        rows = staged(rows.withColumn("node", _next_node(level)), "shard-level")
        level = after
    return rows, level


def shard(docs: DataFrame, shards: int) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    rows, leaves = build(staged(measured(docs), "shard-rows"), shards)
    placed = rows.select("doc_id", "size", "text_crc32",
                         _by_node([leaf.first for leaf in leaves]).cast("int").alias("shard"))
    out = numbered(placed, "shard", ["doc_id", "text_crc32", "size"], "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def shards_for(docs: DataFrame, target_bytes: int) -> int:
    """Number of leaves of the target size."""
    size = F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)) + OVERHEAD
    total = docs.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()[0]
    return max(1, -(-total // target_bytes))
