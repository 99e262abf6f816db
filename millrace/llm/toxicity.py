"""Toxicity by class-conditional Kneser-Ney models.

Counts come from all labelled rows that may be learned from, combined per chunk before the
shuffle. n_c(w) is the number of different words before w in texts of class c: an expression
that keeps returning in one shared passage counts once, one that is used freely counts each
time. Both classes back off to the same shared counts of documents with w:

    P_c(w) = max(n_c(w) - D, 0) / n_c + g_c * documents(w) / all documents(.)

so a rare expression gets what the two classes say together. Counts of the larger class are
scaled to the smaller one's, so that the discount weighs the same in both. Above these stand the
words given the word h before, by documents c_c(h, w) of class c with the pair (0 for the beginning):

    P_c(w | h) = max(c_c(h, w) - D, 0) / c_c(h .) + g_c(h) * P_c(w)

Log-likelihoods are compared per word: over the whole text (the mean of log P_toxic(w | h) -
log P_ordinary(w | h)) and for the single expression that speaks most for toxic, since a few words
make a long text toxic. Pairs within the discount in both classes and histories without others change
nothing; what others add to the ratio of their word is held by hash beside the words' ratios. A logistic curve over the two gives 0 to 1. It is fitted on a part of the
learnable rows (one in five) that gave no counts; of these a hash of the text draws at most about
``CURVE_ROWS``, half of each class, which weigh as many as they stand for.

Every word of the corpus counts, none is cut off by its rank: a word with more than the discount in
either class (and in two documents at least) has a ratio of its own, all others are smoothed alike and
share one, log(g_toxic / g_ordinary). The ratios are broadcast in pieces of ``PIECE`` words (64 MB).
Where there are more pieces, texts pass them one behind the other without a shuffle, since sums
and greatest values add up over pieces.

Null and empty texts have no words: both figures are 0. Words are runs without ASCII blanks or
punctuation, A-Z lowered, in texts of any length. Rows without a label, or with a null label, teach
nothing; of labels that repeat a doc_id the toxic one counts, and repeated rows of a document teach as
often as they are there. When one class has no rows to learn from, or tables are empty, every score is
0. Columns beside doc_id and text are kept by without_toxic() whatever their names, else not looked at.
"""

from __future__ import annotations

from itertools import zip_longest
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.llm.tables import documents, id_filter, id_place, passes, staged
from millrace.llm.text import PUNCT, chunks, mix, sums, words

PIECE = 1 << 22
DISCOUNT = 3.0
CURVE_ROWS, CURVE_SHARE = 40_000, 5
THRESHOLD = 0.7
LEARN_CHUNK = 1 << 20
_PAIR = np.uint64(0x9E3779B97F4A7C15)
#: Stands for every word after a history.
ANY = 0x1B873593CC9E2D51
CLASSES = ("ordinary", "toxic")


class Piece(NamedTuple):
    """Sorted hashes of words with their log P_toxic - log P_ordinary; sorted hashes of histories and of pairs
    with what they add to it for the word that follows."""

    word: np.ndarray
    ratio: np.ndarray
    pair: np.ndarray
    change: np.ndarray


class Model(NamedTuple):
    """Pieces of the words with a ratio of their own, the ratio of all others; the curve."""

    pieces: list[Piece]
    plain: float
    curve: tuple[float, ...] = (1.0, 0.0, 0.0)


def learnable(doc_id: Column) -> Column:
    """Rows whose labels may be read."""
    return F.crc32(doc_id.cast("string")) % 3 != 1


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, for_curve) of the documents whose label may be read."""
    known = (labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
             .filter("doc_id is not null and toxic in (0, 1)").filter(learnable(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    held = docs.sparkSession.sparkContext.broadcast(id_filter(known, "doc_id"))

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(passes(held.value, batch.column(2)))).select([0, 1])

    near = (documents(docs).filter("doc_id is not null").withColumn("place", id_place("doc_id"))
            .mapInArrow(keep, "doc_id long, text string"))
    # Labels grow with the documents, so they are never the side to broadcast.
    return near.join(known.hint("merge"), "doc_id").select(
        F.coalesce("text", F.lit("")).alias("text"), "toxic",
        (F.pmod(F.xxhash64("doc_id"), F.lit(CURVE_SHARE)) == 0).alias("for_curve"))


def _counted(row, code, batch, names):
    """Documents of a chunk by class for each code; ``row`` says whose each code is."""
    order = np.lexsort((row, code))
    code, row = code[order], row[order]
    first = np.concatenate([[True], (code[1:] != code[:-1]) | (row[1:] != row[:-1])])[:len(code)]
    code, row = code[first], row[first]
    bad = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)[row]
    cut = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])[:len(code)])
    both = np.diff(np.append(cut, len(code)))
    toxic = np.add.reduceat(bad, cut) if len(cut) else both
    return pa.RecordBatch.from_arrays(
        [pa.array(code[cut].view(np.int64)), pa.array(both - toxic), pa.array(toxic)], names)


def _row_of_word(found):
    return np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))


def _followed(batch, data, at):
    """(word before, word, toxic) of every different pair of neighbours of every document; 0 is before the first."""
    found = words(data, at, PUNCT)
    row = _row_of_word(found)
    before = np.concatenate([[np.uint64(0)], found.hash[:-1]])[:len(found.hash)]
    before[found.first[:-1][np.diff(found.first) > 0]] = 0
    order = np.lexsort((found.hash, before, row))
    before, word, row = before[order], found.hash[order], row[order]
    new = (before[1:] != before[:-1]) | (word[1:] != word[:-1]) | (row[1:] != row[:-1])
    first = np.concatenate([[True], new])[:len(word)]
    toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
    return before[first], word[first], toxic[row[first]]


def _per_key(keys, toxic):
    """Different rows of ``keys`` (arrays, sorted by the last first), and how many of each are ordinary and toxic."""
    order = np.lexsort(keys)
    keys, toxic = [k[order] for k in keys], toxic[order]
    new = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    cut = np.flatnonzero(np.concatenate([[True], new])[:len(toxic)])
    both = np.diff(np.append(cut, len(toxic)))
    bad = np.add.reduceat(toxic, cut) if len(cut) else both
    return [k[cut].view(np.int64) for k in keys], both - bad, bad


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, ordinary, toxic, after_ordinary, after_toxic): documents of either class with the word, and their
    different pairs that begin with it. Word 0, the beginning of a text, is in none."""
    names = ["word", "ordinary", "toxic", "after_ordinary", "after_toxic"]

    def count(batches):
        for batch, data, at in chunks(batches, size=LEARN_CHUNK):
            found = words(data, at, PUNCT)
            own = _counted(_row_of_word(found), found.hash, batch, names[:3])
            none = pa.array(np.zeros(own.num_rows, np.int64))
            yield pa.RecordBatch.from_arrays([*own.columns, none, none], names)
            before, _, toxic = _followed(batch, data, at)
            (word,), ordinary, toxic = _per_key([before], toxic)
            none = np.zeros(len(word), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (word, none, none, ordinary, toxic)], names)

    return (texts.select("text", "toxic").mapInArrow(count, ", ".join(f"{n} long" for n in names))
            .groupBy("word").agg(*[F.sum(n).alias(n) for n in names[1:]]))


def pair_counts(texts: DataFrame) -> DataFrame:
    """(before, word, ordinary, toxic): documents of either class in which the word follows that before."""
    names = ["before", "word", "ordinary", "toxic"]

    def count(batches):
        for batch, data, at in chunks(batches, size=LEARN_CHUNK):
            before, word, toxic = _followed(batch, data, at)
            keys, ordinary, toxic = _per_key([before, word], toxic)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*keys, ordinary, toxic)], names)

    return (texts.select("text", "toxic").mapInArrow(count, ", ".join(f"{n} long" for n in names))
            .groupBy("before", "word").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")))


def continuations(pairs: DataFrame, often: Column) -> DataFrame:
    """(word, before, ordinary, toxic): with before null, different words before each word by class;
    further the counts of the pairs that are ``often``."""
    one = [F.when(F.col(c) > 0, 1).otherwise(0).cast("long").alias(c) for c in CLASSES]
    every = F.struct("word", F.lit(None).cast("long").alias("before"), *one)
    rows = F.when(often, F.array(every, F.struct("word", "before", *CLASSES))).otherwise(F.array(every))
    return pairs.select(F.inline(rows)).groupBy("word", "before").agg(*[F.sum(c).alias(c) for c in CLASSES])


def places(vocabulary: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Place in the sorted vocabulary, -1 for others."""
    if not len(vocabulary):
        return np.full(len(code), -1)
    at = np.minimum(np.searchsorted(vocabulary, code), len(vocabulary) - 1)
    return np.where(vocabulary[at] == code, at, -1)


def _discounted(factor: dict[str, float]) -> list[Column]:
    """Counts of the larger class scaled to the smaller one's, less the discount."""
    return [F.greatest(F.col(c) * factor[c] - DISCOUNT, F.lit(0.0)).alias(c) for c in CLASSES]


def _pieces(rows: DataFrame, piece: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pieces of a table of (hash, figure), sorted by hash."""
    held = rows.toPandas()
    code, figure = held.iloc[:, 0].to_numpy(np.int64).view(np.uint64), held.iloc[:, 1].to_numpy(float)
    order = np.argsort(code)
    code, figure = code[order], figure[order]
    return [(code[k:k + piece], figure[k:k + piece]) for k in range(0, max(len(code), 1), piece)]


def _coded(batches):
    """(code, change) of (before, word, change)."""
    for batch in batches:
        before, word = (batch.column(c).to_numpy().view(np.uint64) for c in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(mix(before * _PAIR + word).view(np.int64)), batch.column(2)],
                                         ["code", "change"])


def learn(texts: DataFrame, piece: int = PIECE) -> Model | None:
    """The model of all rows of ``texts`` (columns text, toxic); None without both classes."""
    counted = staged(word_counts(texts), "toxicity-words")
    sums_of = [F.coalesce(F.sum(c), F.lit(0)) for c in ("ordinary", "toxic", "after_ordinary", "after_toxic")]
    *spoken, followed_o, followed_t = counted.agg(*sums_of).first()
    spoken = sum(spoken)
    if not (followed_o and followed_t):
        return None
    factor = {c: min(followed_o, followed_t) / n for c, n in zip(CLASSES, (followed_o, followed_t))}
    often = F.greatest(*[F.col(c) * factor[c] for c in CLASSES]) > DISCOUNT
    pairs = staged(continuations(pair_counts(texts), often), "toxicity-pairs")
    before = pairs.filter("before is null").drop("before")
    total = before.agg(*[F.sum(c) for c in CLASSES]).first()
    # The larger class scaled to the smaller one's number of pairs.
    size = min(total)
    rated = before.select("word", *_discounted({c: size / n for c, n in zip(CLASSES, total)}))
    held = counted.select("word", (F.col("ordinary") + F.col("toxic")).alias("documents")).filter("documents > 1")
    # Rows of words that occur freely in either class: those with a ratio of their own.
    own = staged(rated.filter("ordinary > 0 or toxic > 0").join(held, "word"), "toxicity-ratios")
    kept = own.agg(*[F.coalesce(F.sum(c), F.lit(0.0)) for c in CLASSES]).first()
    rest = dict(zip(CLASSES, (1 - k / size for k in kept)))
    plain = float(np.log(rest["toxic"] / rest["ordinary"]))
    shared = F.col("documents") / F.lit(float(spoken))
    low = {c: F.col(c) / size + rest[c] * shared for c in CLASSES}
    ratio = F.log(low["toxic"] / low["ordinary"])

    # P_c(w | h) of pairs beyond the discount, and what a history leaves to P_c(w).
    after = counted.select(F.col("word").alias("before"), *[(F.col("after_" + c) * factor[c]).alias("after_" + c) for c in CLASSES])
    kept_pairs = pairs.filter("before is not null").select("before", "word", *_discounted(factor))
    given = {c: F.when(F.col("after_" + c) > 0, F.col(c) / F.col("after_" + c)).otherwise(0.0) for c in CLASSES}
    histories = staged(
        kept_pairs.groupBy("before").agg(*[F.sum(c).alias(c) for c in CLASSES]).join(after, "before")
        .select("before", "after_ordinary", "after_toxic", *[(1 - given[c]).alias("left_" + c) for c in CLASSES]),
        "toxicity-histories")
    back = F.log(F.col("left_toxic") / F.col("left_ordinary"))
    lows = (held.join(own.drop("documents"), "word", "left").na.fill(0.0, list(CLASSES))
            .select("word", *[low[c].alias("low_" + c) for c in CLASSES]))
    full = {c: given[c] + F.col("left_" + c) * F.col("low_" + c) for c in CLASSES}
    change = F.log(full["toxic"] / full["ordinary"]) - back - F.log(F.col("low_toxic") / F.col("low_ordinary"))
    changes = (kept_pairs.join(histories, "before").join(lows, "word").select("before", "word", change.alias("change"))
               .union(histories.select("before", F.lit(ANY).alias("word"), back)))
    changes = staged(changes.mapInArrow(_coded, "code long, change double"), "toxicity-changes")

    empty = (np.zeros(0, np.uint64), np.zeros(0))
    pieces = [Piece(*one, *two) for one, two in zip_longest(
        _pieces(own.select("word", ratio), piece), _pieces(changes, piece), fillvalue=empty)]
    return Model(pieces, plain)


class Figures(NamedTuple):
    """Of each row: words with a ratio of their own, the sum and the greatest of these ratios, and the sum of
    what words before them change."""

    known: np.ndarray
    total: np.ndarray
    most: np.ndarray
    change: np.ndarray

    def plus(self, other: Figures) -> Figures:
        return Figures(self.known + other.known, self.total + other.total, np.maximum(self.most, other.most),
                       self.change + other.change)

    def likelihood(self, count: np.ndarray, plain: float) -> np.ndarray:
        """log P_toxic - log P_ordinary per word of each row, every word given the one before."""
        return (self.total + (count - self.known) * plain + self.change) / np.maximum(count, 1)

    def features(self, count: np.ndarray, plain: float) -> np.ndarray:
        """(mean, greatest) ratio of each row; 0 without words."""
        rest = count - self.known
        mean = (self.total + rest * plain) / np.maximum(count, 1)
        most = np.where(rest > 0, np.maximum(self.most, plain), self.most)
        return np.where(count[:, None] > 0, np.column_stack([mean, most]), 0.0)


def figures(piece: Piece, found) -> Figures:
    place = places(piece.word, found.hash)
    known = place >= 0
    ratio = np.where(known, np.append(piece.ratio, 0.0)[place], -np.inf)
    count = np.diff(found.first)
    most = np.full(len(count), -np.inf)
    if len(ratio):
        most[count > 0] = np.maximum.reduceat(ratio, found.first[:-1][count > 0])
    before = np.concatenate([[np.uint64(0)], found.hash[:-1]])[:len(found.hash)]
    before[found.first[:-1][count > 0]] = 0
    change, worth = np.zeros(len(ratio)), np.append(piece.change, 0.0)
    for follower in (found.hash, np.uint64(ANY)):
        # Place -1 is the last of ``worth``, 0.
        change += worth[places(piece.pair, mix(before * _PAIR + follower))]
    return Figures(sums(known.astype(np.int64), found.first),
                   sums(np.where(known, ratio, 0.0), found.first), most, sums(change, found.first))


def _fresh(taken: list[str], names: tuple[str, ...]) -> list[str]:
    end, lower = "", {c.lower() for c in taken}
    while any(n + end in lower for n in names):
        end += "_"
    return [n + end for n in names]


def measured(frame: DataFrame, model: Model, result, schema) -> DataFrame:
    """``result(rows, features)`` of all rows, where features are the likelihood() and the greatest ratio of the column text.
    Each piece of the model is one pass over the rows; the first ones leave sums in further columns."""
    context, columns = frame.sparkSession.sparkContext, frame.columns
    names = _fresh(columns, ("_known", "_total", "_most", "_change"))

    def so_far(batch, found, piece):
        own = figures(piece, found)
        if names[0] not in batch.schema.names:
            return own
        return own.plus(Figures(*(batch.column(n).to_numpy() for n in names)))

    def add(held):
        def task(batches):
            for batch, data, at in chunks(batches):
                own = so_far(batch, words(data, at, PUNCT), held.value)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *map(pa.array, own)],
                                                 [*columns, *names])
        return task

    def finish(held, plain):
        def task(batches):
            for batch, data, at in chunks(batches):
                found = words(data, at, PUNCT)
                own = so_far(batch, found, held.value)
                count = np.diff(found.first)
                yield result(batch.select(columns),
                             np.column_stack([own.likelihood(count, plain), own.features(count, plain)[:, 1]]))
        return task

    *earlier, last = [context.broadcast(p) for p in model.pieces]
    wider = T.StructType(list(frame.schema.fields))
    if earlier:
        for name, kind in zip(names, ("long", "double", "double", "double")):
            wider = wider.add(name, kind)
    for held in earlier:
        frame = frame.mapInArrow(add(held), wider)
    return frame.mapInArrow(finish(last, model.plain), schema)


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, ...]:
    """Weights and shift of a logistic curve, by Newton steps with a weak prior."""
    weight = np.ones(len(y)) if weight is None else weight
    unit = np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([x / unit, np.ones(len(x))])
    beta, prior = np.zeros(z.shape[1]), 1e-2
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + prior * np.eye(len(beta))
        move = np.linalg.solve(hessian, z.T @ (weight * (y - p)) - prior * beta)
        beta = beta + np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-9:
            break
    return (*(beta[:-1] / unit).tolist(), float(beta[-1]))


def train(docs: DataFrame, labels: DataFrame, piece: int = PIECE) -> Model | None:
    """Model with its curve, from the labels that may be read."""
    texts = staged(labelled_texts(docs, labels), "toxicity-texts")
    model = learn(texts.filter("not for_curve"), piece)
    if model is None:
        return None
    apart = texts.filter("for_curve")
    share = F.lit(1.0)
    for row in apart.groupBy("toxic").count().collect():
        if 2 * row["count"] > CURVE_ROWS:
            share = F.when(F.col("toxic") == row["toxic"], CURVE_ROWS / 2 / row["count"]).otherwise(share)
    place = F.pmod(F.xxhash64(F.lit(11), "text"), F.lit(1 << 52)) / F.lit(float(1 << 52))
    drawn = apart.select("text", "toxic", share.alias("share")).filter(place < F.col("share"))

    def result(batch, x):
        return pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), batch.column(1), batch.column(2)],
                                          ["mean", "most", "toxic", "share"])

    rows = measured(drawn, model, result, "mean double, most double, toxic int, share double").toPandas()
    if not len(rows):
        return model
    return model._replace(curve=fit_curve(rows[["mean", "most"]].to_numpy(), rows["toxic"].to_numpy(),
                                          1 / rows["share"].to_numpy()))


def curve_of(model: Model, x: np.ndarray) -> np.ndarray:
    *weights, shift = model.curve
    return 1 / (1 + np.exp(-np.clip(x @ np.array(weights) + shift, -500, 500)))


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, piece: int = PIECE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = train(docs, labels, piece)
    if model is None:
        rated = documents(docs).select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    else:
        light = model._replace(pieces=[])

        def result(batch, x):
            value = curve_of(light, x)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(value), pa.array((value >= threshold).astype(np.int32))],
                ["doc_id", "score", "predicted"])

        rated = measured(documents(docs), model, result, "doc_id long, score double, predicted int")
    return rated.select("doc_id", F.coalesce(~learnable(F.col("doc_id")), F.lit(False)).alias("held_out"),
                        "score", "predicted")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                  piece: int = PIECE) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    model = train(docs, labels, piece)
    if model is None:
        return docs
    light = model._replace(pieces=[])

    def result(batch, x):
        return batch.filter(pa.array(curve_of(light, x) < threshold))

    return measured(docs, model, result, docs.schema)
