"""Secret scan: candidates from whole texts, false positives removed by a random forest.

A candidate is a run of 16 or more letters, digits, `+ / _ -` (ASCII), or, behind a word that names
a secret and `=` or `:`, the value up to the next ASCII blank (up to the closing quote, where it is
quoted) with whatever characters and length. A run with which such a value begins is part of it. Features are its
length, how its characters follow each other (changes of kind, entropy, letter transitions), how
much of it dictionary words cover, whether it lies in a path or address, and the words
beside it. The forest is trained on labelled findings, about ``TRAIN_ROWS`` of each label at most, by a
hash of their place, weighted by what they stand for; every candidate is scored.

Letter transitions and the dictionary come from a fixed public vocabulary file. Candidates and
features are made in one pass without a shuffle; training sees a bounded table. Columns give the
place and a checksum, never the secret itself.

The test tables have no audited findings, so ``audited`` labels what a reviewer would be sure of:
provider keys and values assigned to a password or token are secrets, plain words and plain
numbers are not; anything else, also short plain words and numbers behind such a name, stays unlabelled and is left to the forest. Where the labels
hold one class only, every candidate gets that class.

Null and empty texts have no candidates. Repeated rows have theirs each.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.tables import documents, staged
from millrace.llm.text import chunks, words

SHORTEST, TRAIN_ROWS, TREES, DEPTH, THRESHOLD = 16, 20_000, 20, 6, 0.5
CONTEXT, PLACES = 48, 1 << 53
OTHER = np.ones(256, bool)
OTHER[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"]] = False

# Words that name a secret, and forms of provider keys: fixed values.
# Nothing is tried twice: blanks and quotes are taken once, so a search is linear in the text.
NAMED = r"(password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth)\s*+[\"']?+\s*+[=:]\s*+[\"']?+"
NAMES = re.compile(NAMED + "$", re.IGNORECASE)
# In bytes; what follows is looked at only, so that a value can hold a further name.
VALUES = re.compile(NAMED.encode() + rb"(?=(\S+))", re.IGNORECASE)
PROVIDER = re.compile(r"(AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|sk_live_[0-9A-Za-z]{24}|"
                      r"AIza[0-9A-Za-z_-]{35}|xox[abpr]-[0-9A-Za-z-]{10,}")

FEATURES = ["length", "kinds_change", "entropy", "different", "digits", "uppers", "symbols",
            "transitions", "dictionary", "in_path", "named", "assigned", "quoted", "plain_neighbours"]
SCHEMA = ("doc_id long, start long, length long, text_crc32 long, label int, features array<double>")


class Dictionary:
    """Words and letter transitions of a public vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            pieces = json.load(file)["model"]["vocab"]
        whole = (p.removesuffix("</w>") for p in pieces)
        self.words = {w for w in whole if len(w) >= 4 and w.isascii() and w.isalpha()}
        count = np.ones((26, 26))
        for word in self.words:
            code = np.frombuffer(word.encode(), np.uint8) - 97
            code = code[code < 26]
            np.add.at(count, (code[:-1], code[1:]), 1)
        self.log = np.log(count / count.sum(axis=1, keepdims=True))
        self.longest = max(map(len, self.words), default=0)

    def coverage(self, text: str) -> float:
        """Share of the text that words cover, longest first from the left."""
        at = covered = 0
        while at < len(text) - 3:
            for size in range(min(self.longest, len(text) - at), 3, -1):
                if text[at:at + size] in self.words:
                    covered += size
                    at += size - 1
                    break
            at += 1
        return covered / len(text)

    def transitions(self, text: str) -> float:
        """Mean log probability of neighbouring letters; the worst value without any."""
        code = np.frombuffer(text.encode(), np.uint8).astype(int) - 97
        pair = (code[:-1] >= 0) & (code[:-1] < 26) & (code[1:] >= 0) & (code[1:] < 26)
        return float(self.log[code[:-1][pair], code[1:][pair]].mean()) if pair.any() else -8.0


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def features(text: str, before: str, after: str, held: Dictionary) -> list[float]:
    n, kinds = len(text), [_kind(c) for c in text]
    count = Counter(text)
    entropy = -sum(k / n * math.log2(k / n) for k in count.values())
    glued = re.search(r"\S*$", before).group()
    beside = (before.split()[-1:] + after.split()[:1])
    lower = text.lower()
    return [
        float(n), sum(a != b for a, b in zip(kinds, kinds[1:])) / max(n - 1, 1), entropy, len(count) / n,
        kinds.count(0) / n, kinds.count(2) / n, kinds.count(3) / n, held.transitions(lower),
        held.coverage(lower), float("/" in text or "://" in glued or "/" in glued),
        float(bool(NAMES.search(before))), float(bool(re.search(r"[=:]\s*[\"']?$", before))),
        float(before[-1:] in {"'", '"'} and before[-1:] == after[:1]),
        sum(w.strip(".,;:").isalpha() for w in beside) / 2]


def audited(text: str, before: str) -> int | None:
    """1 secret, 0 none, None unsure."""
    if PROVIDER.fullmatch(text):
        return 1
    if NAMES.search(before):
        bare = text.strip(".,;:!?()[]{}<>")
        return None if len(text) < SHORTEST and (not bare or bare.isdigit() or bare.isalpha()) else 1
    if text.isdigit() or (text.isalpha() and (text.islower() or text.istitle())):
        return 0
    return None


def named_values(raw: bytes, low: int, high: int) -> dict[int, tuple[int, int]]:
    """Start: (end, start of the name) of the values behind a secret's name in raw[low:high]."""
    out = {}
    for m in VALUES.finditer(raw[low:high]):
        quote, value = m.group()[-1:], m.group(2)
        if quote in (b"'", b'"'):
            value = value.split(quote, 1)[0]
        else:
            value = value.rstrip(b"\"'")
        if value:
            out.setdefault(low + m.end(), (low + m.end() + len(value), low + m.start()))
    return out


def candidates(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Every candidate with its place, checksum, audited label (or null) and features."""
    names = ["doc_id", "start", "length", "text_crc32", "label", "features"]

    def find(batches):
        held = Dictionary(vocabulary)
        for batch, data, at in chunks(batches):
            runs = words(data, at, OTHER, lower=False)
            row_of = np.repeat(np.arange(len(at) - 1), np.diff(runs.first))
            raw, out = data.tobytes(), []
            long = runs.end - runs.start >= SHORTEST
            places = {a: (b, a, r) for a, b, r in
                      zip(runs.start[long].tolist(), runs.end[long].tolist(), row_of[long].tolist())}
            for r, (low, high) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                for a, (b, name) in named_values(raw, low, high).items():
                    places[a] = (max(b, places.get(a, (b,))[0]), name, r)
            for a, (b, name, row) in sorted(places.items()):
                text = raw[a:b].decode("utf-8", "replace")
                before = raw[max(int(at[row]), min(name, a - CONTEXT)):a].decode("utf-8", "ignore")
                after = raw[b:min(int(at[row + 1]), b + CONTEXT)].decode("utf-8", "ignore")
                start = len(raw[int(at[row]):a].decode("utf-8", "replace"))
                out.append((row, start, len(text), zlib.crc32(raw[a:b]), audited(text, before),
                            features(text, before, after, held)))
            if out:
                row, start, length, code, label, feature = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(code, pa.int64()),
                     pa.array(label, pa.int32()), pa.array(feature, pa.list_(pa.float64()))], names)

    return documents(docs).mapInArrow(find, SCHEMA)


def forest(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, rows: int = TRAIN_ROWS):
    """A function that adds ``probability`` to candidates, learned from about ``rows`` of ``labelled``
    per label, from all of a label that has no more. Each weighs as many as it stands for."""
    count = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    share, place = F.lit(1.0), F.pmod(F.xxhash64("doc_id", "start", "text_crc32"), F.lit(PLACES))
    for label, n in count.items():
        if n > rows:
            share = F.when(F.col("label") == label, F.lit(rows / n)).otherwise(share)
    chosen = (labelled.withColumn("share", share).filter(place < F.col("share") * PLACES)
              .select(F.col("label").cast("double"), array_to_vector("features").alias("features"),
                      (1 / F.col("share")).alias("weight")))
    n, ones = chosen.agg(F.count("label"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if ones in (0, n):
        return lambda frame: frame.withColumn("probability", F.lit(1.0 if ones else 0.0))
    model = RandomForestClassifier(labelCol="label", featuresCol="features", weightCol="weight",
                                   numTrees=trees, maxDepth=depth, seed=7).fit(chosen)

    def score(frame: DataFrame) -> DataFrame:
        named = frame.withColumn("vector", array_to_vector("features")).drop("features")
        rated = model.setFeaturesCol("vector").setProbabilityCol("rated").transform(named)
        return rated.withColumn("probability", vector_to_array("rated")[1])

    return score


def scan(docs: DataFrame, vocabulary: str, learnable: Column | None = None) -> DataFrame:
    """One row per candidate: doc_id, start, length, text_crc32, probability, secret.
    ``learnable`` says which rows' labels may be read (all, unless given)."""
    found = staged(candidates(docs, vocabulary), "secret-candidates")
    labelled = found.filter("label is not null")
    rated = forest(labelled if learnable is None else labelled.filter(learnable))(found)
    return rated.select("doc_id", "start", "length", "text_crc32", "probability",
                        (F.col("probability") >= THRESHOLD).alias("secret"))
