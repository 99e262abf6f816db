"""Language identification by unigram pieces with all segmentations summed.

Each language has a probability for every piece of a fixed public vocabulary. A word's
likelihood is the sum over all ways to cut it into pieces, found by a forward pass over its
bytes; a text's is the product over its words. The language with the greatest likelihood is
predicted, and its share of the likelihoods of all languages is the score.

Piece probabilities are learned by expectation maximisation, with forward and backward passes over
the distinct words of each language, from at most about ``TRAIN_ROWS`` labelled rows per language:
rows enter by a hash of doc_id under the share that gives this number. Every text is scored
whole. Each distinct word is scored once and remembered in the worker, up to ``REMEMBER`` words.

Words are runs without ASCII blanks or punctuation, A-Z lowered; the single bytes of the
vocabulary make every word possible. Words of one length go through the passes together; those of more
than ``TOGETHER`` bytes, as in scripts without blanks, go one by one, with sums kept in
range position by position. A null text, or one without a letter, is `und` with score 0; so is every text when no
labelled row has a language. Ties go to the first language by name.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.tables import documents, staged
from millrace.llm.text import (_BYTES, _power_tables, LOWER, PUNCT, chunks, mix, ragged, sums,
                               text_buffers, words)

TRAIN_ROWS, ROUNDS, SHARED = 5_000, 3, 0.05
TOGETHER, PIECE_BYTES = 48, 16
REMEMBER = 1_500_000
CHUNK = 4 << 20
SCALE = 10.0  # per byte, so that products of many pieces stay in range


class Model(NamedTuple):
    langs: list[str]
    piece: np.ndarray  # sorted hashes of the pieces
    weight: np.ndarray  # (piece, language): probability times SCALE to the piece's bytes


def vocabulary(path: str) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, bytes) of the pieces inside one word; a word begins with a blank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {bytes([b]) for b in range(256)}
    for k in range(model.get_piece_size()):
        if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k)):
            raw = model.id_to_piece(k).replace("▁", " ").encode()
            if len(raw) <= PIECE_BYTES and b" " not in raw[1:]:
                pieces.add(raw)
    raw = sorted(pieces)
    at = np.concatenate([[0], np.cumsum([len(p) for p in raw])])
    data = np.frombuffer(b"".join(raw), np.uint8)
    code = _range_hash(_prefix(data), at[:-1], at[1:])
    order = np.argsort(code)
    return code[order], np.diff(at)[order]


def _prefix(data: np.ndarray) -> np.ndarray:
    power, _ = _power_tables(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * power[:len(data)], out=total[1:])
    return total


def _range_hash(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, inverse = _power_tables(len(total))
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


class Lattice:
    """Words of one length: which piece lies at each byte range."""

    def __init__(self, piece: np.ndarray, text: np.ndarray, words_in: int):
        length = len(text) // words_in
        total, base = _prefix(text), np.arange(words_in) * length
        self.length, self.edges = length, []
        for end in range(1, length + 1):
            for size in range(1, min(end, PIECE_BYTES) + 1):
                code = _range_hash(total, base + end - size, base + end)
                at = np.minimum(np.searchsorted(piece, code), len(piece) - 1)
                own = np.flatnonzero(piece[at] == code)
                if len(own):
                    self.edges.append((end - size, end, own, at[own]))

    def forward(self, weight: np.ndarray, many: int) -> np.ndarray:
        """(position, word, language): sum over all segmentations up to the position."""
        alpha = np.zeros((self.length + 1, many, weight.shape[-1]))
        alpha[0] = 1
        for start, end, own, at in self.edges:
            alpha[end, own] += alpha[start, own] * weight[at]
        return alpha


def _by_length(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """(word numbers, their bytes behind a blank) for every length that occurs."""
    length = end - start
    for n in np.unique(length):
        own = np.flatnonzero(length == n)
        text = np.full((len(own), n + 1), 32, np.uint8)
        text[:, 1:] = LOWER[data[ragged(start[own], length[own])]].reshape(len(own), n)
        yield own, text.ravel()


class Long:
    """One long word: which piece lies at each byte range, and sums over its segmentations.

    Sums are kept as a number near 1 and a logarithm for each position, so that no length
    leaves the range of floats. A step looks back ``PIECE_BYTES`` bytes only.
    """

    def __init__(self, piece: np.ndarray, text: np.ndarray):
        total = _prefix(text)
        self.length = len(text)
        # By end: the piece that ends there, for every size; -1 for none.
        self.at = np.full((self.length + 1, PIECE_BYTES), -1, np.int64)
        for size in range(1, min(PIECE_BYTES, self.length) + 1):
            end = np.arange(size, self.length + 1)
            code = _range_hash(total, end - size, end)
            place = np.minimum(np.searchsorted(piece, code), len(piece) - 1)
            self.at[end, size - 1] = np.where(piece[place] == code, place, -1)

    def _sums(self, weight: np.ndarray, steps) -> tuple[np.ndarray, np.ndarray]:
        """(number, logarithm) by position and language; ``steps`` are (to, all from, all pieces)."""
        value = np.ones((self.length + 1, weight.shape[1]))
        log = np.zeros_like(value)
        for to, come, pieces in steps:
            base = log[come].max(axis=0)
            sums_ = (value[come] * np.exp(log[come] - base) * weight[pieces]).sum(axis=0)
            top = np.maximum(sums_, 1e-300)
            value[to], log[to] = sums_ / top, base + np.log(top)
        return value, log

    def forward(self, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def steps():
            for end in range(1, self.length + 1):
                size = np.flatnonzero(self.at[end] >= 0) + 1
                yield end, end - size, self.at[end, size - 1]
        return self._sums(weight, steps())

    def backward(self, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def steps():
            for start in range(self.length - 1, -1, -1):
                size = np.arange(1, min(PIECE_BYTES, self.length - start) + 1)
                held = self.at[start + size, size - 1]
                yield start, (start + size)[held >= 0], held[held >= 0]
        return self._sums(weight, steps())

    def score(self, weight: np.ndarray) -> np.ndarray:
        value, log = self.forward(weight)
        return np.log(np.maximum(value[-1], 1e-300)) + log[-1]

    def add_expected(self, out: np.ndarray, lang: int, weight: np.ndarray, count: float) -> None:
        """Add how often each piece is used over all segmentations, ``count`` times."""
        own = weight[:, lang:lang + 1]
        (a, la), (b, lb) = self.forward(own), self.backward(own)
        end, size = np.nonzero(self.at >= 0)
        start, pieces = end - size - 1, self.at[end, size]
        share = a[start, 0] * b[end, 0] * own[pieces, 0] * np.exp(la[start, 0] + lb[end, 0] - la[-1, 0])
        np.add.at(out, (pieces, lang), count * share / max(a[-1, 0], 1e-300))


def _behind_a_blank(data: np.ndarray, start: int, end: int) -> np.ndarray:
    return np.concatenate([[np.uint8(32)], LOWER[data[start:end]]])


def word_scores(model: Model, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """log likelihood of each word in each language."""
    out = np.zeros((len(start), len(model.langs)))
    short = np.flatnonzero(end - start <= TOGETHER)
    for own, text in _by_length(data, start[short], end[short]):
        lattice = Lattice(model.piece, text, len(own))
        final = lattice.forward(model.weight, len(own))[-1]
        out[short[own]] = np.log(np.maximum(final, 1e-300)) - lattice.length * np.log(SCALE)
    for k in np.flatnonzero(end - start > TOGETHER):
        word = Long(model.piece, _behind_a_blank(data, start[k], end[k]))
        out[k] = word.score(model.weight) - word.length * np.log(SCALE)
    return out


def expected_counts(piece: np.ndarray, weight: np.ndarray, data, start, end, lang, count
                    ) -> np.ndarray:
    """(piece, language): how often each piece is used over all segmentations of the words."""
    out = np.zeros(weight.shape)
    for k in np.flatnonzero(end - start > TOGETHER):
        Long(piece, _behind_a_blank(data, start[k], end[k])).add_expected(out, lang[k], weight, count[k])
    short = np.flatnonzero(end - start <= TOGETHER)
    for own, text in _by_length(data, start[short], end[short]):
        lattice = Lattice(piece, text, len(own))
        own = short[own]
        mine = lang[own]
        alpha = np.zeros((lattice.length + 1, len(own)))
        beta = np.zeros_like(alpha)
        alpha[0] = beta[-1] = 1
        for s, e, w, at in lattice.edges:
            alpha[e, w] += alpha[s, w] * weight[at, mine[w]]
        for s, e, w, at in reversed(lattice.edges):
            beta[s, w] += beta[e, w] * weight[at, mine[w]]
        share = count[own] / np.maximum(alpha[-1], 1e-300)
        for s, e, w, at in lattice.edges:
            np.add.at(out, (at, mine[w]), alpha[s, w] * weight[at, mine[w]] * beta[e, w] * share[w])
    return out


# -- learning --------------------------------------------------------------------

def learnable(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 != 2


def training_words(docs: DataFrame, rows_per_language: int = TRAIN_ROWS) -> DataFrame:
    """(lang, word, n) over the labelled rows that are learned from."""
    known = documents(docs, F.col("lang").cast("string").alias("lang")).filter(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull()
        & learnable(F.col("doc_id")))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    keep = F.lit(False)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    for lang, n in sizes.items():
        below = int(1_000_000 * min(1.0, rows_per_language / n)) + 1
        keep = keep | ((F.col("lang") == lang) & (place < below))

    def count(batches):
        for batch, data, at in chunks(batches, size=CHUNK):
            found = words(data, at, PUNCT)
            lang = np.array(batch.column(2).to_pylist(), object)
            lang_code, lang_of = np.unique(lang, return_inverse=True)
            row = np.repeat(lang_of, np.diff(found.first))
            order = np.lexsort((found.hash, row))
            code, row = found.hash[order], row[order]
            cut = np.flatnonzero(np.concatenate(
                [[True], (code[1:] != code[:-1]) | (row[1:] != row[:-1])])[:len(code)])
            # Spelled as in scoring: A-Z lowered and nothing else.
            raw, shown = LOWER[data].tobytes(), order[cut]
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang_code[row[cut]], pa.string()),
                 pa.array([raw[a:b].decode("utf-8", "replace") for a, b in
                           zip(found.start[shown].tolist(), found.end[shown].tolist())], pa.string()),
                 pa.array(np.diff(np.append(cut, len(code))), pa.int64())], ["lang", "word", "n"])

    return (known.filter(keep).mapInArrow(count, "lang string, word string, n long")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def train(docs: DataFrame, path: str, rounds: int = ROUNDS) -> Model:
    """Piece probabilities of every language among the labelled rows."""
    spark = docs.sparkSession
    piece, size = vocabulary(path)
    seen = staged(training_words(docs), "language-words")
    langs = sorted(r["lang"] for r in seen.select("lang").distinct().collect())
    if not langs:
        return Model([], piece, np.zeros((len(piece), 0)))
    place = {lang: k for k, lang in enumerate(langs)}
    grow = SCALE ** size[:, None]
    # Longer pieces begin less likely, or every word would be one piece or many alike.
    share = np.repeat(0.5 ** size[:, None] / (0.5 ** size).sum(), len(langs), axis=1)
    for _ in range(rounds):
        held = spark.sparkContext.broadcast(share * grow)

        def expect(batches):
            for batch in batches:
                data, at = text_buffers(batch.column(1))
                data, at = data[at[0]:at[-1]], at - at[0]
                lang = np.array([place[v] for v in batch.column(0).to_pylist()])
                found = expected_counts(piece, held.value, data, at[:-1], at[1:], lang,
                                        batch.column(2).to_numpy().astype(float))
                p, k = np.nonzero(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p, pa.int32()), pa.array(k, pa.int32()), pa.array(found[p, k])],
                    ["piece", "lang", "n"])

        # At most one row for each piece and language.
        rows = (seen.mapInArrow(expect, "piece int, lang int, n double")
                .groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas())
        count = np.zeros(share.shape)
        count[rows["piece"], rows["lang"]] = rows["n"]
        shared = count.sum(axis=1, keepdims=True) + 0.1
        share = (1 - SHARED) * count / count.sum(axis=0) + SHARED * shared / shared.sum()
    return Model(langs, piece, share * grow)


# -- prediction ------------------------------------------------------------------

_seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _remembered(model: Model, key: int, data, found) -> tuple[np.ndarray, np.ndarray]:
    """(scores of distinct words, which one each word is)."""
    code, index, place = np.unique(found.hash, return_index=True, return_inverse=True)
    known, value = _seen.get(key, (np.zeros(0, np.uint64), np.zeros((0, len(model.langs)), np.float32)))
    if len(known) + len(code) > REMEMBER:
        known, value = known[:0], value[:0]
    new = ~np.isin(code, known, assume_unique=True)
    if new.any():
        fresh = word_scores(model, data, found.start[index[new]], found.end[index[new]])
        at = np.searchsorted(known, code[new])
        known = np.insert(known, at, code[new])
        value = np.insert(value, at, fresh.astype(np.float32), axis=0)
    _seen.clear()
    _seen[key] = known, value
    return value[np.searchsorted(known, code)], place


def _has_letter(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    lower = LOWER[data]
    out = sums((lower >= 97) & (lower <= 122), at) > 0
    for r in np.flatnonzero(~out):
        raw = data[at[r]:at[r + 1]]
        if (raw >= 128).any():
            out[r] = any(c.isalpha() for c in raw.tobytes().decode("utf-8", "replace"))
    return out


def predict_rows(model: Model, key: int, data: np.ndarray, at: np.ndarray
                 ) -> tuple[list[str], np.ndarray]:
    rows = len(at) - 1
    if not model.langs:
        return ["und"] * rows, np.zeros(rows)
    found = words(data, at, PUNCT)
    scores, place = _remembered(model, key, data, found)
    total = np.stack([sums(scores[place, k].astype(float), found.first)
                      for k in range(len(model.langs))], axis=1)
    best = total.argmax(axis=1)
    share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    letters = _has_letter(data, at)
    return ([model.langs[b] if ok else "und" for b, ok in zip(best, letters)],
            np.where(letters, share, 0.0))


def identify(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    model = train(docs, path)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = int(mix(np.array([hash(model.weight.tobytes()) & 0x7FFFFFFFFFFFFFFF], np.uint64))[0])

    def rate(batches):
        for batch, data, at in chunks(batches, size=CHUNK):
            lang, score = predict_rows(shared.value, key, data, at)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()),
                                              pa.array(score)], ["doc_id", "lang_pred", "score"])

    rated = documents(docs).mapInArrow(rate, "doc_id long, lang_pred string, score double")
    return rated.select("doc_id", F.coalesce(~learnable(F.col("doc_id")), F.lit(False)).alias("held_out"),
                        "lang_pred", "score")
