"""Best-fit packing of token sequences by a configuration linear program.

Every document becomes its token ids and an end token; only what is longer than a sequence
is cut. The lengths of the pieces make a histogram with at most ``capacity`` entries, so all
planning runs on the driver on a bounded table, however many documents there are:

1. Lengths are grouped into classes of ``grain`` tokens. The configuration program (cover
   the count of every class with the fewest sequences, a variable per way of filling one)
   is solved by multiplicative weights: each round a knapsack dynamic program finds the
   filling with the greatest price, it is used until it covers one of its classes once, and prices
   of the classes fall exponentially with their coverage. The prices also bound the optimum.
2. Rounding: each configuration is used its whole number of times with real lengths, the
   last places going to the largest lengths that still fit (best fit). What the program
   leaves over is packed by the same rule, largest first. Equal fillings are one run, and every
   run uses up a length or a configuration, so runs are bounded like the histogram.

Pieces are numbered inside each length in parts, so a length that a third of all rows share is
spread out; number and length give sequence and place by binary search in the broadcast
plan, whose size follows the histogram.

A null text counts as empty: its piece is the end token alone. Repeated rows are packed each.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.tables import documents, numbered, staged
from millrace.llm.text import chunks, list_column
from millrace.llm.tokens import encoder

CAPACITY, GRAIN, ROUNDS, STEP, END = 4096, 16, 1000, 0.1, 1
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# -- pieces ----------------------------------------------------------------------

def _cut(batches, vocabulary, capacity, end, with_ids):
    for batch, data, at in chunks(batches):
        ids, own = encoder(vocabulary).encode(data, at)
        row, start, length, code, parts = [], [], [], [], []
        for r in range(len(own) - 1):
            every = np.append(ids[own[r]:own[r + 1]], end).astype("<u4")
            for a in range(0, len(every), capacity):
                part = every[a:a + capacity]
                row.append(r)
                start.append(a)
                length.append(len(part))
                code.append(zlib.crc32(part.tobytes()))
                if with_ids:
                    parts.append(part)
        start = np.array(start, np.int64)
        columns = [batch.column(0).take(pa.array(row)), pa.array(start // capacity, pa.int32()),
                   pa.array(start), pa.array(length, pa.int64()), pa.array(code, pa.int64())]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            ends = np.concatenate([[0], np.cumsum(length)])
            columns.append(list_column(np.concatenate(parts).astype(np.int32), ends))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names)


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    return documents(docs).mapInArrow(lambda b: _cut(b, vocabulary, capacity, end, False), PIECES)


# -- plan ------------------------------------------------------------------------

def best_filling(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> Counter:
    """Unbounded knapsack: how often each size (by index) is taken."""
    best = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    for w in range(1, capacity + 1):
        fits = np.searchsorted(sizes, w, "right")
        best[w] = best[w - 1]
        if fits:
            value = best[w - sizes[:fits]] + prices[:fits]
            k = int(value.argmax())
            if value[k] > best[w]:
                best[w], taken[w] = value[k], k
    filling, w = Counter(), capacity
    while w > 0:
        if taken[w] < 0:
            w -= 1
        else:
            filling[int(taken[w])] += 1
            w -= int(sizes[taken[w]])
    return filling


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = ROUNDS,
                   step: float = STEP, gap: float = 0.01) -> tuple[dict[tuple, float], float]:
    """(how often each configuration is used, lower bound): the configuration program by
    multiplicative weights, until cover and bound are within ``gap`` or rounds run out."""
    weight = sizes / capacity
    covered = np.zeros(len(sizes))
    used: dict[tuple, float] = {}
    bound, total = 0.0, 0.0
    for k in range(rounds):
        filling = best_filling(sizes, weight, capacity)
        take = np.zeros(len(sizes))
        take[list(filling)] = list(filling.values())
        price = float(take @ weight)
        bound = max(bound, float(demand @ weight) / price)
        own = take > 0
        times = float((demand[own] / take[own]).min())
        key = tuple(sorted(filling.items(), reverse=True))
        used[key] = used.get(key, 0.0) + times
        total += times
        share = take * times / demand
        covered += share
        weight = weight * (1 - step) ** share
        weight /= weight.max()
        if k % 50 == 49 and covered.min() > 0 and total / covered.min() <= (1 + gap) * bound:
            break
    volume = float((covered * demand) @ sizes)
    scale = float(demand @ sizes) / volume if volume else 0.0
    return {key: x * scale for key, x in used.items()}, bound


class _Remaining:
    """Pieces left of each length, and the largest length that is left under a limit."""

    def __init__(self, count: np.ndarray):
        self.count = count.copy()
        self.below = list(range(len(count)))
        for v in range(1, len(count)):
            if not count[v]:
                self.below[v] = v - 1
        self.below[0] = 0

    def find(self, limit: int, taken: Counter) -> int:
        v = limit
        while True:
            root = v
            while self.below[root] != root:
                root = self.below[root]
            while self.below[v] != root and v != root:
                self.below[v], v = root, self.below[v]
            if root == 0 or taken[root] < self.count[root]:
                return root
            v = root - 1

    def use(self, pattern: Counter, times: int) -> None:
        for v, n in pattern.items():
            self.count[v] -= n * times
            if not self.count[v]:
                self.below[v] = v - 1


def runs_of(count: np.ndarray, capacity: int, grain: int = GRAIN, rounds: int = ROUNDS
            ) -> tuple[list[tuple[Counter, int]], float]:
    """((lengths in a sequence, number of such sequences) ..., lower bound) for count[length]."""
    left, runs = _Remaining(count), []

    def fill(config: list[int], most: int) -> int:
        pattern, free = Counter(), capacity
        for limit in config:
            v = left.find(min(limit, free), pattern)
            if not v:
                break
            pattern[v] += 1
            free -= v
        while free and (v := left.find(free, pattern)):
            pattern[v] += 1
            free -= v
        if not pattern:
            return 0
        times = min([most, *(int(left.count[v]) // n for v, n in pattern.items())])
        left.use(pattern, times)
        runs.append((pattern, times))
        return times

    lengths = np.flatnonzero(count)
    if not len(lengths):
        return [], 0.0
    classes = -(-lengths // grain)
    sizes = np.unique(classes)
    demand = np.zeros(len(sizes))
    np.add.at(demand, np.searchsorted(sizes, classes), count[lengths])
    used, _ = configurations(sizes, demand, capacity // grain, rounds)
    for key, x in sorted(used.items(), key=lambda kx: [-sizes[i] for i, _ in kx[0]]):
        config = [int(sizes[i]) * grain for i, n in key for _ in range(n)]
        quota = int(x)
        while quota and (times := fill(config[:-1], quota)):
            quota -= times
    everything = int(count.sum())
    while fill([], everything):
        pass
    return runs, float((count * np.arange(len(count))).sum()) / capacity


class Plan:
    """Where the r-th piece of a length goes: (sequence, offset) by binary search."""

    def __init__(self, runs: list[tuple[Counter, int]]):
        seen, rows, base = Counter(), [], 0
        for pattern, times in runs:
            offset = 0
            for v in sorted(pattern, reverse=True):
                rows.append((v, seen[v], pattern[v], base, offset))
                seen[v] += pattern[v] * times
                offset += v * pattern[v]
            base += times
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.key = (table[:, 0] << 44) | table[:, 1]
        _, self.begin, self.many, self.base, self.offset = table.T
        self.sequences = base

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << 44) | rank, "right") - 1
        nth = rank - self.begin[at]
        return (self.base[at] + nth // self.many[at],
                self.offset[at] + nth % self.many[at] * length)


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END,
         grain: int = GRAIN) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = staged(pieces(docs, vocabulary, capacity, end), "packing-pieces")
    count = np.zeros(capacity + 1, np.int64)
    for length, n in cut.groupBy("length").count().collect():  # at most `capacity` rows
        count[length] = n
    runs, _ = runs_of(count, capacity, grain)
    plan = docs.sparkSession.sparkContext.broadcast(Plan(runs))
    ranked = numbered(cut, "length", ["doc_id", "piece", "start", "ids_crc32"], "rank")

    def placed(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = plan.value.place(length, rank)
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(placed, PIECES + ", sequence_id long, offset long")


def sequences(docs: DataFrame, packed: DataFrame, vocabulary: str, capacity: int = CAPACITY,
              end: int = END) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, each at most ``capacity`` ids."""
    cut = documents(docs).mapInArrow(lambda b: _cut(b, vocabulary, capacity, end, True),
                                     PIECES + ", ids array<int>")
    rows = cut.select("doc_id", "piece", "ids").join(
        packed.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"])
    gathered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return (rows.groupBy("sequence_id").agg(gathered.alias("parts"))
            .select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids")))
