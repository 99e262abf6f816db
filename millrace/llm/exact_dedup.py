"""Exact deduplication against a history of digests held in minimal perfect hashes.

Texts are equal when they agree after every blank (space, tab to carriage return) is taken
out. Distinct digests of the history are dealt by hash into buckets; each bucket gets a
minimal perfect hash (levels of bits: a key settles in the first level where no other key
of the bucket falls on its place, and its slot is the number of set bits before it). A slot
holds the full digest, the winner so far (characters, doc_id) and how many rows there
were. A new batch is combined to one row per digest before it is shuffled, so a text with a
third of all rows costs one row per task; a lookup compares all 32 bytes. Digests that are
not members form groups of their own.

Of a group the row with the most code points stays, then the smallest doc_id, then the smallest
row number where rows have one. A null text counts as empty; a null doc_id loses against any
other. Rows repeated under one doc_id share their decision in exact_dedup(); copies_of_rows() keeps
one of them. Texts of any length are hashed whole; an empty history, batch or table is no special
case; columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from millrace.llm.tables import documents, staged
from millrace.llm.text import mix
from millrace.operators.skew import join_per_key

BUCKET_KEYS = 20_000
HOT_KEYS, HOT_COPIES = 5_000, 1_000
GROUP = "digest string, chars long, keep_id long, keep_row long, group_size long"
INDEX = ("bucket long, level_sizes array<int>, bits binary, digests binary, "
         "chars array<long>, winners array<long>, rows array<long>, sizes array<long>")


def digests(docs: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, row (0 without that column), digest (SHA-256 of the text without blanks, hex), chars
    (code points)."""
    text = F.coalesce("text", F.lit(""))
    number = F.lit(0) if row is None else F.col(row)
    return documents(docs, number.cast("long").alias("row")).select(
        "doc_id", "row", F.sha2(F.regexp_replace(text, r"[\x20\x09-\x0D]", ""), 256).alias("digest"),
        F.length(text).cast("long").alias("chars"))


def winners(rows: DataFrame) -> DataFrame:
    """One row per digest: who stays so far, and the number of rows."""
    # Bits turned over order numbers backwards, the smallest long included.
    best = F.max(F.struct("chars", F.bitwise_not("doc_id").alias("id"), F.bitwise_not("row").alias("row")))
    return (rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size"))
            .select("digest", "best.chars", F.bitwise_not("best.id").alias("keep_id"),
                    F.bitwise_not("best.row").alias("keep_row"), "group_size"))


class PerfectHash:
    """Minimal perfect hash over distinct keys of four 64-bit words."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes = sizes
        self.base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.bits = bits
        self.rank = np.concatenate([[0], np.cumsum(bits)]).astype(np.int64)

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        word = keys[:, level % 4] ^ (keys[:, (level + 1) % 4] >> np.uint64(7))
        seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        return (mix(word + seed) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, sizes, levels = np.arange(len(keys)), [], []
        while len(left):
            size = max(64, 2 * len(left))
            at = cls.place(keys[left], len(sizes), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            level = np.zeros(size, bool)
            level[at[alone]] = True
            sizes.append(size)
            levels.append(level)
            left = left[~alone]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of every member; any slot, or -1, for others."""
        slot = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = self.base[level] + self.place(keys[left], level, size)
            hit = self.bits[at]
            slot[left[hit]] = self.rank[at[hit]]
            left = left[~hit]
        return slot


def _keys(digest: pd.Series) -> np.ndarray:
    return np.frombuffer(bytes.fromhex("".join(digest)), "<u8").reshape(-1, 4)


def _index_bucket(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    keys = _keys(rows["digest"])
    hashed = PerfectHash.build(keys)
    order = np.argsort(hashed.slots(keys))
    rows = rows.iloc[order]
    return pd.DataFrame([{
        "bucket": key[0], "level_sizes": hashed.sizes, "bits": np.packbits(hashed.bits).tobytes(),
        "digests": keys[order].tobytes(), "chars": rows["chars"].tolist(),
        "winners": [None if pd.isna(v) else int(v) for v in rows["keep_id"].array],
        "rows": rows["keep_row"].tolist(), "sizes": rows["group_size"].tolist()}])


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket")


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket of the distinct digests in ``history`` (columns of winners())."""
    return (history.select("*", _bucket(buckets)).groupBy("bucket")
            .applyInPandas(_index_bucket, INDEX))


def _match(index: pd.DataFrame, batch: pd.DataFrame) -> pd.DataFrame:
    names = ["digest", "chars", "keep_id", "keep_row", "group_size"]
    batch = batch[names].astype({"keep_id": "Int64"})
    if index.empty:
        return batch
    row = index.iloc[0]
    held = np.frombuffer(row["digests"], "<u8").reshape(-1, 4)
    raw = held.tobytes()
    known = pd.DataFrame({
        "digest": [raw[k:k + 32].hex() for k in range(0, len(raw), 32)],
        "chars": row["chars"], "keep_id": pd.array(
            [None if v is None or v != v else int(v) for v in row["winners"]], "Int64"),
        "keep_row": row["rows"], "group_size": row["sizes"]})
    if batch.empty:
        return known
    sizes = list(row["level_sizes"])
    bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(sizes)).astype(bool)
    keys = _keys(batch["digest"])
    slot = PerfectHash(sizes, bits).slots(keys)
    member = slot >= 0
    member[member] = (held[slot[member]] == keys[member]).all(axis=1)
    new, at = batch[member], slot[member]
    old = known.iloc[at]
    # Most characters, then an id at all, the smallest one, the smallest row.
    order = [[-x["chars"].to_numpy(np.int64), x["keep_id"].isna().to_numpy(),
              x["keep_id"].fillna(0).to_numpy(np.int64), x["keep_row"].to_numpy(np.int64)] for x in (new, old)]
    wins, tied = np.zeros(len(new), bool), np.ones(len(new), bool)
    for mine, theirs in zip(*order):
        wins |= tied & (mine < theirs)
        tied &= mine == theirs
    column = known.columns.get_loc
    known.iloc[at, column("group_size")] += new["group_size"].to_numpy()
    for name in ("chars", "keep_row"):
        known.iloc[at[wins], column(name)] = new[name].to_numpy()[wins]
    known.iloc[at[wins], column("keep_id")] = new["keep_id"].array[wins]
    return pd.concat([known, batch[~member]])


def merge(index: DataFrame, batch: DataFrame, buckets: int) -> DataFrame:
    """Groups of history and batch together: members join their slot, others are new."""
    return (index.groupBy("bucket").cogroup(batch.select("*", _bucket(buckets)).groupBy("bucket"))
            .applyInPandas(_match, GROUP))


def _decided(docs: DataFrame, is_history, row: str | None, bucket_keys: int, hot_copies: int) -> DataFrame:
    """Every row with its group: doc_id, row, digest, keep_id, keep_row, group_size."""
    rows = staged(digests(docs, row).withColumn("old", F.coalesce(is_history, F.lit(False))), "dedup-rows")
    history = staged(winners(rows.filter("old")), "dedup-history")
    batch = staged(winners(rows.filter("not old")), "dedup-batch")
    buckets = max(1, -(-max(history.count(), batch.count()) // bucket_keys))
    index = staged(build_index(history, buckets), "dedup-index")
    groups = staged(merge(index, batch, buckets).drop("chars"), "dedup-groups")
    return join_per_key(rows.select("doc_id", "row", "digest"), groups, "digest", "group_size",
                        ("doc_id", "row"), HOT_KEYS, hot_copies)


def exact_dedup(docs: DataFrame, is_history, bucket_keys: int = BUCKET_KEYS,
                hot_copies: int = HOT_COPIES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``is_history`` is a condition on doc_id: those rows came first and are indexed, all
    others are looked up.
    """
    found = _decided(docs, is_history, None, bucket_keys, hot_copies)
    return found.select("doc_id", "keep_id", "group_size",
                        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                        F.col("digest").alias("text_sha256"))


def copies_of_rows(docs: DataFrame, row: str, is_history, bucket_keys: int = BUCKET_KEYS,
                   hot_copies: int = HOT_COPIES) -> DataFrame:
    """row: the numbers of the rows that go, where the column ``row`` numbers rows uniquely. One row of
    each group of equal texts stays, whatever ids they have."""
    found = _decided(docs, is_history, row, bucket_keys, hot_copies)
    return found.filter("row <> keep_row").select("row")


def earlier_half(docs: DataFrame):
    """Condition for the rows up to the middle of the doc_id range."""
    low, high = documents(docs).agg(F.min("doc_id"), F.max("doc_id")).first()
    return F.col("doc_id") <= F.lit((low + high) // 2 if low is not None else 0).cast("long")
