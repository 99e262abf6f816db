"""Periodic run detection over words, by string synchronising sets.

A run is a stretch of words with smallest period q, at least four periods long, that
cannot be extended. For every scale t = 1, 2, 4, ... positions are chosen by content alone: a
position is in the set of scale t if the smallest hash of the t-word windows at it and the t
positions behind it lies at one of the two ends. Equal surroundings are chosen
alike, and without a period of t/4 or less, t neighbouring positions hold a chosen one. So in a run of
period q, t <= q < 2t, some chosen position and the one q further both lie in it with the
same 2t words behind them, and no chosen position between them has these: neighbours
among equal contexts propose all periods. Windows with a period of t/4 or less are
left out of scale t; they lie in the runs of small period that smaller scales have found, which
are kept apart for that. A proposed period is then extended word by word to its run.

Words are compared by 64-bit hashes, ranked within a chunk of documents; documents of a chunk
are kept apart by words that occur nowhere else. A document costs O(n log^2 n), its
memory follows the chunk (about 1 MB of text) or the longest text; long texts are split into
words piece by piece. Nothing is shuffled.

A null or blank text has no words, no runs and an empty collapsed text. Repeated rows get equal
results, a null doc_id is kept, an empty table gives an empty result, and columns other
than doc_id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.tables import documents
from millrace.llm.text import BLANK, CHUNK, Words, chunks, mix, ragged, words

EXPONENT, SHORTEST = 4, 6
RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, text string"
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def words_in_pieces(data: np.ndarray, at: np.ndarray, size: int = CHUNK) -> Words:
    """words(), case kept; one long text is cut at blanks into pieces of about ``size`` bytes."""
    if len(at) != 2 or len(data) <= 2 * size:
        return words(data, at, lower=False)
    parts, low = [], 0
    while low < len(data):
        high = min(low + size, len(data))
        while high < len(data) and not BLANK[data[high]]:
            ahead = np.flatnonzero(BLANK[data[high:high + size]])
            high = high + int(ahead[0]) if len(ahead) else min(high + size, len(data))
        found = words(data[low:high], np.array([0, high - low]), lower=False)
        parts.append((found.start + low, found.end + low, found.hash))
        low = high
    start, end, code = (np.concatenate(x) for x in zip(*parts))
    return Words(np.array([0, len(start)]), start, end, code)


def _ahead(values: np.ndarray, step: int) -> np.ndarray:
    """values[i + step]; zero behind the end, where every window holds the last row's own word."""
    out = np.zeros_like(values)
    out[:len(values) - step] = values[step:]
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours; ``width`` is a power of two."""
    values, step = values.copy(), 1
    while step < width:
        values[:-step] = np.minimum(values[:-step], values[step:])
        step *= 2
    return values


def _left_out(found: list[np.ndarray], place: np.ndarray, scale: int) -> np.ndarray | None:
    """Marks of the windows of ``scale`` words with a period of a quarter of it or less."""
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    runs = runs[(runs[:, 2] * 4 <= scale) & (runs[:, 1] - runs[:, 0] >= scale)]
    low = np.minimum(np.searchsorted(place, runs[:, 0]), len(place) - 1)
    here = place[low] == runs[:, 0]
    runs, low = runs[here], low[here]
    if not len(runs):
        return None
    edge = np.zeros(len(place) + 1, np.int32)
    np.add.at(edge, low, 1)
    np.add.at(edge, low + runs[:, 1] - runs[:, 0] - scale + 1, -1)
    return np.cumsum(edge[:-1]) > 0


def _chosen(name: np.ndarray, scale: int, left_out: np.ndarray | None) -> np.ndarray:
    """The synchronising set of a scale; ``name`` are hashes of windows of ``scale`` words."""
    if scale == 1:
        return np.arange(len(name))
    shown = name if left_out is None else np.where(left_out, _NONE, name)
    last = _ahead(shown, scale)
    least = np.minimum(_least(shown, scale), last)
    return np.flatnonzero((least != _NONE) & ((least == shown) | (least == last)))


def _proposals(context: np.ndarray, place: np.ndarray, chosen: np.ndarray, scale: int
               ) -> tuple[np.ndarray, np.ndarray]:
    """(positions, periods) from neighbours among equal contexts of the chosen positions."""
    order = chosen[np.argsort(context[chosen], kind="stable")]
    held, at = context[order], place[order]
    apart = at[1:] - at[:-1]
    near = (held[1:] == held[:-1]) & (apart >= scale) & (apart < 2 * scale)
    return at[:-1][near], apart[near]


def _extended(code: np.ndarray, low: int, high: int, period: int, at: np.ndarray) -> np.ndarray:
    """The runs (start, end, period) of one document that hold the positions ``at``."""
    own = code[low:high]
    breaks = np.concatenate([[-1], np.flatnonzero(own[:-period] != own[period:]), [len(own) - period]])
    k = np.unique(np.searchsorted(breaks, at - low, "left"))
    start, end = low + breaks[k - 1] + 1, low + breaks[k] + period
    keep = end - start >= EXPONENT * period
    return np.stack([start, end, np.full(len(k), period)], 1)[keep]


def runs_of(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """All runs (start, end, period) of at least four periods in the sequences
    ``code[first[r]:first[r + 1]]``, by start, then period."""
    count = np.diff(first)
    _, rank = np.unique(code, return_inverse=True)
    # A word of its own behind each sequence; places count these words too.
    row = np.repeat(np.arange(len(count)), count)
    spaced = np.zeros(len(code) + len(count), np.int64)
    spaced[np.arange(len(code)) + row] = rank
    begin, end = first[:-1] + np.arange(len(count)), first[1:] + np.arange(len(count))
    spaced[end] = len(code) + np.arange(len(count))
    row = np.repeat(np.arange(len(count)), count + 1)
    place, name = np.arange(len(spaced)), mix(spaced.astype(np.uint64) + _LEFT)
    found: list[np.ndarray] = []
    scale, longest = 1, int(count.max(initial=0))
    while EXPONENT * scale <= longest:
        # Only sequences with room for four periods go on.
        stays = count[row] >= EXPONENT * scale
        row, place, name = row[stays], place[stays], name[stays]
        context = mix(name * _LEFT + _ahead(name, scale) * _RIGHT)
        chosen = _chosen(name, scale, _left_out(found, place, scale))
        at, period = _proposals(context, place, chosen, scale)
        if len(at):
            owner = np.searchsorted(begin, at, "right") - 1
            order = np.lexsort((at, period, owner))
            at, period, owner = at[order], period[order], owner[order]
            cut = np.flatnonzero((np.diff(period) != 0) | (np.diff(owner) != 0)) + 1
            for part in np.split(np.arange(len(at)), cut):
                r = owner[part[0]]
                found.append(_extended(spaced, int(begin[r]), int(end[r]), int(period[part[0]]), at[part]))
        name, scale = context, 2 * scale
    if not found:
        return np.zeros((0, 3), np.int64)
    runs = np.concatenate(found)
    # The same stretch with a multiple of its period is no run of its own.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    fresh = np.ones(len(runs), bool)
    fresh[1:] = (np.diff(runs[:, 0]) != 0) | (np.diff(runs[:, 1]) != 0)
    runs = runs[fresh]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    shift = np.searchsorted(begin, runs[:, 0], "right") - 1
    runs[:, :2] -= shift[:, None]
    return runs


def _joined(data: np.ndarray, found: Words, kept: np.ndarray, piece: int = 100_000
            ) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words of each row, one blank between them, and row offsets."""
    padded = np.append(data, np.uint8(32))
    out = []
    for low in range(0, len(kept), piece):
        part = kept[low:low + piece]
        size = found.end[part] - found.start[part] + 1
        held = padded[ragged(found.start[part], size)]
        held[np.cumsum(size) - 1] = 32
        out.append(held)
    size = np.concatenate([[0], np.cumsum(found.end[kept] - found.start[kept] + 1)])
    rows = np.searchsorted(kept, found.first, "left")
    count, at = np.diff(rows), size[rows]
    whole = np.concatenate(out) if out else np.zeros(0, np.uint8)
    # The blank behind each row's last word goes.
    last = at[1:][count > 0] - 1
    keep = np.ones(len(whole), bool)
    keep[last] = False
    return whole[keep], at - np.concatenate([[0], np.cumsum(count > 0)])


def _chunk(rows: pa.RecordBatch, data: np.ndarray, at: np.ndarray, shortest: int) -> pa.RecordBatch:
    found = words_in_pieces(data, at)
    runs = runs_of(found.hash, found.first)
    runs = runs[runs[:, 1] - runs[:, 0] >= shortest]
    edge = np.zeros(len(found.hash) + 1, np.int32)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    text, ends = _joined(data, found, kept)
    owner = np.searchsorted(found.first, runs[:, 0], "right") - 1
    # Empty rows share their start with the row behind them.
    lists = np.searchsorted(owner, np.arange(rows.num_rows + 1), "left").astype(np.int32)
    struct = pa.StructArray.from_arrays(
        [pa.array(runs[:, 0] - found.first[owner]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])],
        ["start", "length", "period"])
    collapsed = pa.LargeStringArray.from_buffers(
        rows.num_rows, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(text))
    return pa.RecordBatch.from_arrays(
        [rows.column("doc_id"), pa.array(np.diff(found.first)),
         pa.ListArray.from_arrays(pa.array(lists), struct), collapsed.cast(pa.string())],
        ["doc_id", "n_words", "runs", "text"])


def find_runs(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), and the text with
    one period of every run: the words of a run behind its first period go, one blank
    stays between words."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, at in chunks(batches):
            yield _chunk(rows, data, at, shortest)

    return documents(docs).mapInArrow(task, RUNS)


def with_cycles(docs: DataFrame) -> DataFrame:
    """Plants a cycle in every tenth document: with h the CRC-32 of the decimal doc_id and
    g = h div 10, a text with h % 10 = 0 repeats the p = 1 + (n - a) div (3 + g % 8) words from
    word a = g % n on to its end. A null doc_id plants none."""
    h = F.crc32(F.col("doc_id").cast("string"))
    plants = F.coalesce(h % 10 == 0, F.lit(False))
    cut = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = (documents(docs).withColumn("h", h)
            .withColumn("w", F.when(plants, cut)).withColumn("n", F.size("w"))
            .withColumn("a", F.expr("if(n > 0, (h div 10) % n, 0L)"))
            .withColumn("p", F.expr("if(n > 0, 1 + (n - a) div (3 + (h div 10) % 8), 1L)")))
    turned = F.expr("""array_join(transform(sequence(0, n - 1), i ->
        w[cast(if(i < a, i, a + (i - a) % p) as int)]), ' ')""")
    return rows.select("doc_id", F.when(F.col("n") > 0, turned).otherwise(F.col("text")).alias("text"))


def best_run(runs: str = "runs") -> Column:
    """The run with the greatest length / period; ties: smallest start, then period. Both
    numbers are below 2^24, so equal quotients, and only those, are equal as doubles."""
    return F.expr(f"""array_max(transform({runs}, r -> struct(
        cast(r.length as double) / r.period as exponent, -r.start as s, -r.period as p, r as run))).run""")
