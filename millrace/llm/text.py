"""Words of many texts at once: Arrow batches in, NumPy arrays out.

Texts stay in the byte buffers Arrow delivers them in. A chunk is a run of whole rows with
about ``CHUNK`` bytes of text, so memory follows the chunk and the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
# Blanks and every other ASCII character that is neither letter nor digit.
PUNCT = BLANK.copy()
PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LENGTH = np.uint64(0xD6E8FEB86659FD93)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


class Words(NamedTuple):
    """Words in text order: row of the chunk, byte range, 64-bit hash; ``first[r]:first[r + 1]``
    are the words of row r."""

    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size
            else np.zeros(0, np.uint8)), at


def chunks(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = CHUNK
           ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of each chunk."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, at = text_buffers(batch.column(batch.schema.get_field_index(column)))
        low = 0
        while low < batch.num_rows:
            high = int(np.searchsorted(at, at[low] + size, "right")) - 1
            high = min(max(high, low + 1), batch.num_rows)
            yield (batch.slice(low, high - low), data[at[low]:at[high]],
                   at[low:high + 1] - at[low])
            low = high


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, CHUNK + 1)
        tables = []
        for base in (_BASE, _INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table))
        _powers = tuple(tables)
    return _powers


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = BLANK,
          lower: bool = True, cuts: np.ndarray | None = None) -> Words:
    """Maximal runs of bytes that are no separators, A-Z lowered unless ``lower`` is off;
    a further word begins inside a run at each position in ``cuts``.

    Equal words have equal hashes in every chunk: a polynomial over the bytes, shifted to
    the word's start, length added, mixed.
    """
    n, rows = len(data), len(offsets) - 1
    if not n:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(rows + 1, np.int64), none, none, np.zeros(0, np.uint64))
    shown = LOWER[data] if lower else data
    inside = ~separator[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    if cuts is not None:
        begins[cuts] = True
        ends[cuts - 1] = True
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    power, inverse = _power_tables(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[shown] * power[:n], out=total[1:])
    code = mix((total[end] - total[start]) * inverse[start]
               + (end - start).astype(np.uint64) * _LENGTH)
    return Words(np.searchsorted(start, offsets, "left"), start, end, code)


_STEP = np.array([pow(_BASE, k + 3, 1 << 64) for k in range(5)], np.uint64)


def shingles(found: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets by row) of every run of ``width`` words of a row, in text order.
    A row with fewer words, but one at least, has its whole sequence as one."""
    first, code = found.first, found.hash
    count = np.diff(first)
    steps = np.resize(_STEP, width)
    runs = np.maximum(count - width + 1, 0)
    shorter = np.flatnonzero((count > 0) & (runs == 0))
    at = np.concatenate([[0], np.cumsum(np.where((count > 0) & (runs == 0), 1, runs))])
    out = np.zeros(at[-1], np.uint64)
    if len(code) >= width:
        every = np.zeros(len(code) - width + 1, np.uint64)
        for k in range(width):
            every += code[k:len(code) - width + 1 + k] * steps[k]
        long = np.repeat(runs > 0, np.diff(at))
        out[long] = every[ragged(first[:-1], runs)]
    for r in shorter:
        own = code[first[r]:first[r + 1]]
        out[at[r]] = (own * steps[:len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
    return mix(out), at


def ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (count[0] of them), start[1], ..."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(count) - count
    return np.repeat(np.asarray(start, np.int64) - before, count) + np.arange(total)


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of values[at[r]:at[r + 1]]; empty ranges give 0."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[at[1:]] - total[at[:-1]]


def list_column(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values))
