"""Benchmark decontamination by a BM25 index of test items with block-max WAND.

Items are the documents of the index, training passages the queries. Entries (an item, or parts
of ``ENTRY`` words of a long one) get BM25 weights, divided by what the entry scores against
itself, so a score says which share of an entry's weight a passage holds. Entries lie in blocks,
ordered by length, and the index keeps the greatest weight of each term in each block.

Every text is read whole, in passages of three frames of ``FRAME`` words that move on by one
frame, so any run of ``ENTRY`` words lies inside a passage. The block maxima of a passage's terms
bound what an entry of the block can score; only (passage, block) pairs that reach the
threshold are scored, and all entries above it are kept. What is found is verified: of the
item's question and of its answer (its last sentence) at least ``OVERLAP`` of the runs of three
words must occur in the document.

The index is built in shards of ``SHARD`` entries and broadcast in groups of at most ``GROUP_BYTES``, one
pass over the documents for each group; a benchmark of usual size is one group. Term
statistics cover the whole benchmark. The documents are not shuffled.

Null or empty texts hold nothing. Items with fewer than ``FEWEST`` words are too short to tell and
match nothing. Repeated items match each; without items or documents there are no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.tables import documents
from millrace.llm.text import PUNCT, Words, chunks, mix, text_buffers, words

FRAME, ENTRY, FEWEST = 32, 64, 5
BLOCK, SHARD, GROUP_BYTES = 8, 1024, 64 << 20
K1, B = 1.2, 0.75
THRESHOLD, OVERLAP, RUN = 0.6, 0.6, 3
FOUND = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
_STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


class Block(NamedTuple):
    """Entries of one block: their terms and the weights, a column per entry."""

    term: np.ndarray
    weight: np.ndarray
    item: np.ndarray


class Shard(NamedTuple):
    """``most[t, b]``: greatest weight of term t in block b."""

    term: np.ndarray
    most: np.ndarray
    blocks: list[Block]
    question: dict[int, np.ndarray]
    answer: dict[int, np.ndarray]
    item_id: dict[int, int]


def runs(code: np.ndarray, length: int = RUN) -> np.ndarray:
    """Hashes of all runs of ``length`` words, of the whole where it is shorter."""
    length = min(length, len(code))
    if not length:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(code) - length + 1, np.uint64)
    for k in range(length):
        total += code[k:len(code) - length + 1 + k] * _STEP[k]
    return mix(total + np.uint64(length))


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence or line is the answer; the whole is both where a part is too short."""
    body = text.rstrip()
    ends = [m.end() for m in re.finditer(r"[.!?]\s|\n", body)]
    if ends:
        question, answer = body[:ends[-1]], body[ends[-1]:]
        if min(len(question.split()), len(answer.split())) >= RUN:
            return question, answer
    return body, body


def _codes(texts: list[str]) -> Words:
    data, at = text_buffers(pa.array(texts, pa.string()))
    return words(data[at[0]:at[-1]], at - at[0], PUNCT)


def _entries(benchmark: DataFrame) -> Iterator[tuple[int, str, np.ndarray]]:
    """(item_id, text, word hashes) of items long enough; one partition at a time."""
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    for row in rows.filter("item_id is not null and text is not null").toLocalIterator():
        code = _codes([row.text]).hash
        if len(code) >= FEWEST:
            yield row.item_id, row.text, code


def _parts(code: np.ndarray) -> list[np.ndarray]:
    many = -(-len(code) // ENTRY)
    return np.array_split(code, many)


def _shard(entries: list[tuple[int, str, np.ndarray]], term: np.ndarray, idf: np.ndarray,
           mean: float) -> Shard:
    question, answer, item_id, rows = {}, {}, {}, []
    for k, (item, text, code) in enumerate(entries):
        q, a = question_and_answer(text)
        question[k], answer[k], item_id[k] = runs(_codes([q]).hash), runs(_codes([a]).hash), item
        for part in _parts(code):
            own, tf = np.unique(part, return_counts=True)
            place = np.searchsorted(term, own)
            weight = idf[place] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(part) / mean))
            rows.append((len(part), k, own, weight / weight.sum()))
    rows.sort(key=lambda r: (r[0], r[1]))
    own = np.unique(np.concatenate([r[2] for r in rows]))
    most = np.zeros((len(own), -(-len(rows) // BLOCK)), np.float32)
    blocks = []
    for b in range(most.shape[1]):
        part = rows[b * BLOCK:(b + 1) * BLOCK]
        here = np.unique(np.concatenate([r[2] for r in part]))
        weight = np.zeros((len(here), len(part)), np.float32)
        for c, (_, _, terms, w) in enumerate(part):
            weight[np.searchsorted(here, terms), c] = w
        place = np.searchsorted(own, here)
        most[place, b] = weight.max(axis=1)
        blocks.append(Block(place, weight, np.array([r[1] for r in part])))
    return Shard(own, most, blocks, question, answer, item_id)


def _added(term: np.ndarray, df: np.ndarray, parts: list[np.ndarray]
           ) -> tuple[np.ndarray, np.ndarray]:
    """Terms and the number of entries that have them, with further entries."""
    more = np.concatenate([term, *parts])
    term, place = np.unique(more, return_inverse=True)
    return term, np.bincount(place, np.concatenate([df, np.ones(len(more) - len(df))]),
                             minlength=len(term))


def index_groups(benchmark: DataFrame, shard: int = SHARD, group_bytes: int = GROUP_BYTES
                 ) -> Iterator[list[Shard]]:
    """Groups of index shards, each group small enough to broadcast."""
    term, df, parts = np.zeros(0, np.uint64), np.zeros(0), []
    count = total = 0
    for _, _, code in _entries(benchmark):
        for part in _parts(code):
            parts.append(np.unique(part))
            count += 1
            total += len(part)
        if len(parts) >= 4 * shard:
            term, df, parts = *_added(term, df, parts), []
    if not count:
        return
    term, df = _added(term, df, parts)
    idf = np.log(1 + (count - df + 0.5) / (df + 0.5))
    group, size, batch = [], 0, []

    def built():
        return _shard(batch, term, idf, total / count)

    for entry in _entries(benchmark):
        batch.append(entry)
        if len(batch) == shard:
            group.append(built())
            size += group[-1].most.nbytes
            batch = []
            if size >= group_bytes:
                yield group
                group, size = [], 0
    if batch:
        group.append(built())
    if group:
        yield group


def _candidates(shard: Shard, found: Words, threshold: float) -> dict[tuple[int, int], float]:
    """(row, item in shard): best score of a passage of the row at or above the threshold."""
    first = found.first
    count = np.diff(first)
    frames = -(-count // FRAME)
    frame_first = np.concatenate([[0], np.cumsum(frames)])
    place = np.minimum(np.searchsorted(shard.term, found.hash), len(shard.term) - 1)
    known = np.flatnonzero(shard.term[place] == found.hash)
    row = np.searchsorted(first, known, "right") - 1
    frame = frame_first[row] + (known - first[row]) // FRAME
    # A passage begins at every frame of a row that has two behind it, or at the row's first.
    lowest = frame_first[row]
    highest = np.maximum(lowest, frame_first[row + 1] - 3)
    pairs = []
    for back in range(3):
        start = frame - back
        fits = (start >= lowest) & (start <= highest)
        pairs.append(start[fits] * len(shard.term) + place[known[fits]])
    pair = np.unique(np.concatenate(pairs))
    if not len(pair):
        return {}
    at, term = pair // len(shard.term), pair % len(shard.term)
    cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    bound = np.add.reduceat(shard.most[term], cut, axis=0)
    ends = np.append(cut[1:], len(pair))
    row_of = np.searchsorted(frame_first, at[cut], "right") - 1
    best: dict[tuple[int, int], float] = {}
    for p, b in np.argwhere(bound >= threshold - 1e-4):
        terms, block = term[cut[p]:ends[p]], shard.blocks[b]
        near = np.minimum(np.searchsorted(block.term, terms), len(block.term) - 1)
        score = block.weight[near[block.term[near] == terms]].sum(axis=0)
        for c in np.flatnonzero(score >= threshold - 1e-4):
            key = (int(row_of[p]), int(block.item[c]))
            best[key] = max(best.get(key, 0.0), float(score[c]))
    return best


def leaks(group: list[Shard], data: np.ndarray, at: np.ndarray, threshold: float = THRESHOLD,
          overlap: float = OVERLAP) -> list[tuple[int, int, float, float, float]]:
    """(row, item_id, score, question overlap, answer overlap) of all verified leaks."""
    found = words(data, at, PUNCT)
    out, own = [], {}
    if not len(found.hash):
        return out
    for shard in group:
        for (row, item), score in sorted(_candidates(shard, found, threshold).items()):
            if row not in own:
                own[row] = np.unique(runs(found.hash[found.first[row]:found.first[row + 1]]))
            q, a = (float(np.isin(part[item], own[row]).mean())
                    for part in (shard.question, shard.answer))
            if q >= overlap and a >= overlap:
                out.append((row, shard.item_id[item], score, q, a))
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
               overlap: float = OVERLAP) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap) of every verified leak."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], FOUND)
    for group in index_groups(benchmark):
        shards = spark.sparkContext.broadcast(group)

        def find(batches, shards=shards):
            for batch, data, at in chunks(batches):
                hits = leaks(shards.value, data, at, threshold, overlap)
                if hits:
                    row, *rest = zip(*hits)
                    kinds = (pa.int64(), pa.float64(), pa.float64(), pa.float64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(row)),
                         *(pa.array(v, k) for v, k in zip(rest, kinds))],
                        ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        out = out.union(documents(docs).mapInArrow(find, FOUND))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                  overlap: float = OVERLAP) -> DataFrame:
    """The documents that hold no test item, with all their columns."""
    spark = docs.sparkSession
    for group in index_groups(benchmark):
        shards = spark.sparkContext.broadcast(group)

        def keep(batches, shards=shards):
            for batch, data, at in chunks(batches):
                clean = np.ones(batch.num_rows, bool)
                clean[[hit[0] for hit in leaks(shards.value, data, at, threshold, overlap)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
