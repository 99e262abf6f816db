"""Hard negatives: for every anchor and each of its best positives, the highest rows of other
labels inside a band below the positive's score.

Scores are exact integer inner products by the method of the Four Russians. Components become
integers; eight dimensions form a group. For an anchor, every group has a table of the sums
of all 256 subsets of its eight numbers. A candidate is packed once as bit planes: one byte per
group and bit of its numbers, in two's complement. A score is the sum over planes of 2^b times the
table entries that the plane's bytes point at, the sign plane counted negative.

Candidates are packed in blocks in parallel and dealt to slabs of about ``SLAB`` rows;
anchors form groups of about ``ANCHORS``. Each (group, slab) is one task, which reads its anchors
first and then its candidates block by block, so memory holds the tables of one group and one
block. Both kinds of row are copied once per group or slab they meet, in packed form. A task
returns at most ``positives`` (then ``negatives`` per positive) rows per anchor, which are merged per
anchor. There is no cap on candidates: every row is scored against every anchor.

Ties go to the smaller vec_id. A row without label, vec_id or vector, or with a null or non-finite
component, takes no part. Vectors may differ in length: missing dimensions count as zero. Numbers
are held to +-2^20 (components beyond 4,096 in size score as that). Rows that repeat a vec_id are rows of
their own, each an anchor where the id is one; columns other than vec_id, embedding and label are not
looked at. Empty tables and anchors without positives give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.tables import staged

GRID, LIMIT = 256, 1 << 20
ANCHORS, SLAB, BLOCK = 128, 1 << 20, 4096
POSITIVES, NEGATIVES = 5, 3
MOST_PARTS = 20_000
# A band of the positive's score, in hundredths.
LOWEST, HIGHEST = 50, 95
_BITS = np.array([[(byte >> k) & 1 for byte in range(256)] for k in range(8)], np.int64)
PACKED = "row long, rows int, dims int, vec_id binary, labels binary, row_ids binary, planes binary"


def quantised(rows: DataFrame, label: Column) -> DataFrame:
    """row (unique), vec_id, label, numbers of every row that takes part. ``label`` is computed from
    the columns vec_id and label."""
    held = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding")
    sound = F.expr("""vec_id is not null and label is not null and embedding is not null and
        forall(embedding, x -> coalesce(not isnan(x) and abs(cast(x as double)) < double('Infinity'), false))""")
    numbers = F.expr(f"""transform(embedding, x -> cast(greatest(least(
        floor({GRID}D * cast(x as double)), {LIMIT}D - 1), -{LIMIT}D) as int))""")
    return (held.filter(sound).select(F.monotonically_increasing_id().alias("row"), "vec_id",
                                      label.cast("long").alias("label"), numbers.alias("numbers")))


def bit_planes(numbers: np.ndarray) -> np.ndarray:
    """(planes, groups, rows) bytes: bit k of the byte is that plane's bit of dimension 8 g + k.
    The last plane is the sign."""
    count, dims = numbers.shape
    most = int(max(numbers.max(initial=0), -1 - numbers.min(initial=0)))
    wide = np.zeros((count, max(1, -(-dims // 8)) * 8), np.int64)
    wide[:, :dims] = numbers
    return np.stack([np.packbits(((wide >> b) & 1).astype(np.uint8), axis=1, bitorder="little").T
                     for b in range(most.bit_length() + 1)])


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, anchors, 256): sums of all subsets of eight numbers."""
    count, dims = anchors.shape
    wide = np.zeros((count, max(1, -(-dims // 8)) * 8), np.int64)
    wide[:, :dims] = anchors
    return np.ascontiguousarray((wide.reshape(count, -1, 8) @ _BITS).transpose(1, 0, 2))


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(anchors, rows): exact inner products by table lookups, shifts and additions."""
    groups = min(len(tables), planes.shape[1])
    bound = int(np.abs(tables).max(initial=0)) * max(groups, 1)
    narrow = bound << len(planes) < 1 << 31
    tables = tables.astype(np.int32 if narrow else np.int64)
    total = np.zeros((tables.shape[1], planes.shape[2]), tables.dtype)
    for b in range(len(planes) - 1, -1, -1):
        # Horner's rule from the sign plane down: double what is there, add the plane's sums.
        np.left_shift(total, 1, out=total)
        for g in range(groups):
            part = np.take(tables[g], planes[b, g], axis=1)
            if b == len(planes) - 1:
                np.subtract(total, part, out=total)
            else:
                np.add(total, part, out=total)
    return total


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of numbers, shorter ones filled with zeros."""
    length = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), int(length.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < length[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def pack(rows: DataFrame) -> DataFrame:
    """Blocks of candidates: ids, labels and bit planes in binary columns."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK):
                part = batch.slice(low, BLOCK)
                ids = part.column("vec_id").to_numpy()
                # Ascending ids, so that of equal scores the earlier place is the smaller id.
                order = np.lexsort((part.column("row").to_numpy(), ids))
                planes = bit_planes(_matrix(part.column("numbers"))[order])
                yield pa.RecordBatch.from_pylist([{
                    "row": part.column("row")[0].as_py(), "rows": part.num_rows, "dims": planes.shape[1],
                    "vec_id": ids[order].tobytes(),
                    "labels": part.column("label").to_numpy()[order].tobytes(),
                    "row_ids": part.column("row").to_numpy()[order].tobytes(),
                    "planes": planes.tobytes()}], schema=schema)

    schema = pa.schema([("row", pa.int64()), ("rows", pa.int32()), ("dims", pa.int32()),
                        ("vec_id", pa.binary()), ("labels", pa.binary()), ("row_ids", pa.binary()),
                        ("planes", pa.binary())])
    return rows.mapInArrow(task, PACKED)


def _unpacked(batch: pa.RecordBatch, k: int):
    get = lambda name: batch.column(name)[k].as_py()
    ids, label, row = (np.frombuffer(get(n), np.int64) for n in ("vec_id", "labels", "row_ids"))
    planes = np.frombuffer(get("planes"), np.uint8).reshape(-1, get("dims"), len(ids))
    return ids, label, row, planes


def _gathered(blocks: list) -> tuple:
    """Several blocks as one; planes are filled up with copies of the sign."""
    high, wide = (max(b[3].shape[k] for b in blocks) for k in (0, 1))
    planes = []
    for *_, p in blocks:
        p = np.pad(p, ((0, 0), (0, wide - p.shape[1]), (0, 0)))
        planes.append(np.concatenate([p, *[p[-1:]] * (high - len(p))]))
    return (*(np.concatenate([b[k] for b in blocks]) for k in range(3)), np.concatenate(planes, axis=2))


def _best(held: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """(score, vec_id, row) of the highest ``count``, ties by smaller id, then row."""
    if len(score) > 8 * count:
        # Only those that reach the count-th highest score can be among them.
        least = np.partition(score, len(score) - count)[len(score) - count]
        near = score >= least
        score, ids, rows = score[near], ids[near], rows[near]
    every = np.concatenate([held, np.stack([score, ids, rows], 1)])
    return every[np.lexsort((every[:, 2], every[:, 1], -every[:, 0]))][:count]


class Group:
    """The anchors of a task, and the best rows found so far for each of their searches.

    A search is (same label or other, lowest score, highest score, rows wanted).
    """

    def __init__(self, anchors: list[dict], count: int, same: bool):
        dims = max(len(a["numbers"]) for a in anchors)
        numbers = np.zeros((len(anchors), dims), np.int64)
        for k, a in enumerate(anchors):
            numbers[k, :len(a["numbers"])] = a["numbers"]
        self.tables = subset_sums(numbers)
        self.anchors, self.count, self.same = anchors, count, same
        self.found = [[np.zeros((0, 3), np.int64) for _ in a["bands"]] for a in anchors]

    def add(self, ids: np.ndarray, label: np.ndarray, row: np.ndarray, planes: np.ndarray) -> None:
        if self.same:
            # Only rows of the anchors' own labels are scored, label by label.
            by = {}
            for k, a in enumerate(self.anchors):
                by.setdefault(a["label"], []).append(k)
            parts = [(np.array(k), np.flatnonzero(label == value)) for value, k in by.items()]
        else:
            parts = [(np.arange(len(self.anchors)), np.arange(len(ids)))]
        for who, where in parts:
            if not len(where):
                continue
            # Bands of candidates keep the score matrix of a large block small.
            for low in range(0, len(where), BLOCK):
                at = where[low:low + BLOCK]
                whole = scores(self.tables[:, who], planes[:, :, at])
                for k, score in zip(who, whole):
                    self._take(k, score, ids[at], label[at], row[at])

    def _take(self, k: int, score, ids, label, row) -> None:
        a = self.anchors[k]
        other = (row != a["row"]) if self.same else (label != a["label"])
        for j, (lowest, highest) in enumerate(a["bands"]):
            held = self.found[k][j]
            if len(held) == self.count:
                lowest = max(lowest, int(held[-1, 0]))
            fits = np.flatnonzero((score >= lowest) & (score <= highest) & other)
            if len(fits):
                self.found[k][j] = _best(held, score[fits].astype(np.int64), ids[fits], row[fits], self.count)

    def result(self) -> pa.RecordBatch:
        out = [(a["row"], j, *map(int, hit)) for k, a in enumerate(self.anchors)
               for j in range(len(a["bands"])) for hit in self.found[k][j]]
        columns = list(zip(*out)) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                          ["anchor", "search", "score", "vec_id", "row"])


def search(anchors: DataFrame, blocks: DataFrame, count: int, same: bool, group: int = ANCHORS,
           slab: int = SLAB) -> DataFrame:
    """anchor (row), search, score, vec_id, row: for every band of every anchor the ``count`` best rows
    of its label (other rows only), or of other labels. ``anchors`` has row, label, numbers and
    bands (list of lowest, highest score); both inputs are written tables."""
    held = anchors.agg(F.count("*")).first()[0]
    total = blocks.agg(F.sum("rows")).first()[0] or 0
    groups, slabs = max(1, -(-held // group)), max(1, -(-total // slab))
    where = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    none = lambda names, like: [F.lit(None).cast(like.schema[c].dataType).alias(c) for c in names]
    first, later = ["label", "numbers", "bands"], ["rows", "dims", "vec_id", "labels", "row_ids", "planes"]
    queries = anchors.select(F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("group"),
                             F.explode(where(slabs)).alias("slab"), F.lit(0).alias("kind"), "row",
                             *first, *none(later, blocks))
    stock = blocks.select(F.explode(where(groups)).alias("group"),
                          F.pmod(F.xxhash64("row"), F.lit(slabs)).cast("int").alias("slab"),
                          F.lit(1).alias("kind"), "row", *none(first, anchors), *later)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, waiting, team, stored = None, [], None, []

        def flush():
            if stored and team:
                team.add(*_gathered(stored))
            stored.clear()

        for batch in batches:
            for k in range(batch.num_rows):
                here = batch.column("group")[k].as_py(), batch.column("slab")[k].as_py()
                if here != key:
                    flush()
                    if team:
                        yield team.result()
                    key, waiting, team = here, [], None
                if batch.column("kind")[k].as_py() == 0:
                    waiting.append({c: batch.column(c)[k].as_py() for c in ("row", "label", "numbers")} | {
                        "bands": [(b["lowest"], b["highest"]) for b in batch.column("bands")[k].as_py()]})
                    continue
                if waiting and team is None:
                    team = Group(waiting, count, same)
                if team:
                    stored.append(_unpacked(batch, k))
                    if sum(len(b[0]) for b in stored) >= BLOCK:
                        flush()
        flush()
        if team:
            yield team.result()

    keys = ["group", "slab"]
    # A number of partitions, so that small ones are not put together and run one by one.
    dealt = (queries.unionByName(stock).repartition(min(2 * groups * slabs, MOST_PARTS), *keys)
             .sortWithinPartitions(*keys, "kind", "row"))
    found = dealt.mapInArrow(task, "anchor long, search long, score long, vec_id long, row long")
    order = Window.partitionBy("anchor", "search").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= count)


def mine(rows: DataFrame, label: Column, is_anchor: Column, positives: int = POSITIVES,
         negatives: int = NEGATIVES, lowest: int = LOWEST, highest: int = HIGHEST,
         group: int = ANCHORS, slab: int = SLAB) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, one row per
    negative returned. ``lowest`` and ``highest``: the band, in hundredths of the positive's score."""
    usable = staged(quantised(rows, label), "negatives-rows")
    blocks = staged(pack(usable), "negatives-blocks")
    anchors = staged(usable.filter(is_anchor), "negatives-anchors")
    everything = F.expr("array(named_struct('lowest', -9223372036854775807L, 'highest', 9223372036854775807L))")
    first = staged(search(anchors.withColumn("bands", everything), blocks, positives, True, group, slab)
                   .select("anchor", (F.col("place") - 1).alias("search"), "score", "vec_id"),
                   "negatives-positives")
    # 100 * score between lowest and highest hundredths of the positive's, as whole numbers.
    band = F.expr(f"""named_struct('at', search,
        'lowest', {lowest} * score div 100 + if({lowest} * score > 0 and {lowest} * score % 100 <> 0, 1L, 0L),
        'highest', {highest} * score div 100 - if({highest} * score < 0 and {highest} * score % 100 <> 0, 1L, 0L))""")
    bands = (first.groupBy(F.col("anchor").alias("row")).agg(F.sort_array(F.collect_list(band)).alias("b"))
             .select("row", F.expr("transform(b, x -> named_struct('lowest', x.lowest, 'highest', x.highest))")
                     .alias("bands")))
    seeking = staged(anchors.join(bands, "row"), "negatives-bands")
    hits = search(seeking, blocks, negatives, False, group, slab)
    names = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    chosen = first.select("anchor", "search", F.col("vec_id").alias("positive_id"),
                          F.col("score").alias("positive_score"))
    return (hits.select("anchor", "search", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"),
                        F.col("score").alias("negative_score"))
            .join(chosen, ["anchor", "search"]).join(names, "anchor")
            .select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score",
                    "negative_score"))
