"""Isolation forest over one numeric column (M5, M6).

After Liu, Ting and Zhou, "Isolation Forest" (ICDM 2008). Trees are grown on
bounded samples, one task per tree. With one feature every tree cuts the number
line into intervals, so the whole forest is a step function of the value: at most
``trees * sample`` steps whatever the table size. Only that step function is
brought to the driver; scoring is then a search for the value among the
borders of the anomalous steps.

A store that grows run by run keeps, per run, its rows of the sample (the rows with the smallest
hashes of all) and how often its values occur. Both add up over runs, so a forest over the
whole history is fitted without reading it.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from millrace import contract as K

_EULER = 0.5772156649
# Values of a run are counted exactly up to about so many different ones.
VALUE_POINTS = 65_536
# Else in bins of 2^-m of the value, the finest of these that gives no more bins.
BIN_BITS = (32, 28, 24, 20, 18, 16, 14, 13, 12, 11, 10)


def path_adjustment(n: float) -> float:
    """Mean path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n <= 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + _EULER) - 2.0 * (n - 1.0) / n


def isolation_leaves(sample: np.ndarray, rng: np.random.Generator) -> list[tuple[float, float]]:
    """(upper end, path length) of each leaf, left to right, for one random tree."""
    values = np.sort(sample)
    limit = math.ceil(math.log2(max(len(values), 2)))
    leaves: list[tuple[float, float]] = []
    todo = [(0, len(values), 0, math.inf)]
    while todo:
        start, end, depth, upper = todo.pop()
        low, high = values[start], values[end - 1]
        if depth >= limit or low == high:
            leaves.append((upper, depth + path_adjustment(end - start)))
            continue
        cut = rng.uniform(low, high)
        middle = start + int(np.searchsorted(values[start:end], cut, side="right"))
        todo.append((middle, end, depth + 1, upper))
        todo.append((start, middle, depth + 1, cut))
    return leaves


@dataclass(frozen=True)
class Forest:
    """Step function of the anomaly score: ``scores[i]`` holds for values in
    ``(borders[i-1], borders[i]]``, and above ``threshold`` a value is anomalous."""

    borders: np.ndarray
    scores: np.ndarray
    threshold: float

    def intervals(self) -> list[tuple[float, float]]:
        """Anomalous value ranges (low, high], neighbours merged."""
        out: list[tuple[float, float]] = []
        lows = np.concatenate(([-math.inf], self.borders))
        highs = np.concatenate((self.borders, [math.inf]))
        for low, high, score in zip(lows, highs, self.scores):
            if score <= self.threshold:
                continue
            if out and out[-1][1] == low:
                out[-1] = (out[-1][0], float(high))
            else:
                out.append((float(low), float(high)))
        return out

    def flags(self, column: str) -> Column:
        """M6: true where the forest calls the value anomalous.

        The ends of the anomalous ranges are one sorted array; a value lies in a range if an odd
        number of ends is below it. They are counted in two steps, among every ``step``-th end
        and then in the one stretch that is left.
        """
        largest = float(np.finfo(np.float64).max)
        ends = [min(max(x, -largest), largest) for pair in self.intervals() for x in pair]
        if not ends:
            return F.lit(False)
        step = max(1, math.isqrt(len(ends)))
        numbers = lambda xs: f"from_json('{json.dumps(xs)}', 'array<double>')"
        return F.expr(f"""transform(array(size(filter({numbers(ends[step - 1::step])}, e -> e < `{column}`))),
            c -> (c * {step} + size(filter(slice({numbers(ends)}, c * {step} + 1, {step}), e -> e < `{column}`)))
                 % 2 = 1)[0]""")

    def score(self, value: float) -> float:
        return float(self.scores[np.searchsorted(self.borders, value, side="left")])


def _uniform(keys: tuple[str, ...], seed: int) -> Column:
    """A number in [0, 1) that depends on the row's key only."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 52)).cast("double") / float(1 << 52)


def _finite(values: DataFrame, column: str) -> DataFrame:
    c = F.col(column)
    return values.filter(c.isNotNull() & ~F.isnan(column) & (F.abs(c) != float("inf")))


def bottom_sample(values: DataFrame, keys: tuple[str, ...], column: str = "value", *,
                  size: int = K.FOREST_TREES * K.FOREST_SAMPLE, seed: int = K.FOREST_SEED,
                  beside: DataFrame | None = None) -> DataFrame:
    """(u, v): the ``size`` finite values whose rows have the smallest hashes u of their keys.

    The smallest of several samples together are the sample of all their rows. ``beside`` is
    such a sample that is known already: rows that cannot get into the common one are left out, so of a
    run among many few are kept. Rows are first thinned by a cut that leaves about four
    times the size, so that the exact top-k sees few even when the table has very many.
    """
    finite = _finite(values, column)
    cut = min(1.0, 4.0 * size / max(finite.count(), 1))
    if beside is not None:
        held, last = _smallest(beside, size).agg(F.count(F.lit(1)), F.max("u")).first()
        cut = min(cut, last) if held == size else cut
    rows = finite.select(F.col(column).alias("v"), _uniform(keys, seed).alias("u"))
    return _smallest(rows.filter(F.col("u") <= cut), size).select("u", "v")


def _smallest(rows: DataFrame, size: int) -> DataFrame:
    return rows.orderBy("u", "v").limit(size)


def value_counts(values: DataFrame, column: str = "value", points: int = VALUE_POINTS) -> DataFrame:
    """(low, high, rows): how often finite values occur. Up to about ``points`` different values are
    counted one by one (low = high); else in bins of a width relative to the value, the finest
    that give no more bins, with the smallest and largest value in each."""
    v = F.col(column)
    finite = _finite(values, column).select(v.alias("v"))
    power = F.when(F.col("v") == 0, 0).otherwise(F.floor(F.log2(F.abs("v"))))

    def bins(bits: int) -> Column:
        return F.struct(power, F.floor(F.col("v") * F.pow(F.lit(2.0), F.lit(bits) - power)))

    different = finite.agg(F.approx_count_distinct("v"), *[F.approx_count_distinct(bins(m)) for m in BIN_BITS]).first()
    fits = [k for k, n in enumerate(different) if n <= points]
    level = fits[0] if fits else len(BIN_BITS)
    key = F.col("v") if level == 0 else bins(BIN_BITS[level - 1])
    return finite.groupBy(key.alias("bin")).agg(
        F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("rows")).drop("bin")


def fit_stored(samples: DataFrame, counts: DataFrame, *, trees: int = K.FOREST_TREES,
               sample: int = K.FOREST_SAMPLE, contamination: float = K.FOREST_CONTAMINATION,
               seed: int = K.FOREST_SEED) -> Forest | None:
    """M5 from the samples and value counts of several runs: trees and steps are those that
    fit_forest() grows over all their rows. So is the threshold where values were counted one by
    one; a bin counts with the highest score of its two ends."""
    total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    if total == 0:
        return None
    borders, scores = _grow(_smallest(samples, trees * sample), total, trees, sample, seed)

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = np.zeros(len(scores), dtype="int64")
        for batch in batches:
            ends = np.stack([np.searchsorted(borders, batch[c].to_numpy(), side="left") for c in ("low", "high")])
            best = ends[np.argmax(scores[ends], axis=0), np.arange(ends.shape[1])]
            np.add.at(rows, best, batch["rows"].to_numpy())
        used = np.flatnonzero(rows)
        yield pd.DataFrame({"step": used.astype("int32"), "rows": rows[used]})

    counted = counts.select("low", "high", "rows").mapInPandas(step, "step int, rows bigint")
    return Forest(borders, scores, _threshold(counted, scores, contamination))


def fit_forest(values: DataFrame, keys: tuple[str, ...], column: str = "value", *,
               trees: int = K.FOREST_TREES, sample: int = K.FOREST_SAMPLE,
               contamination: float = K.FOREST_CONTAMINATION,
               seed: int = K.FOREST_SEED) -> Forest | None:
    """M5: fit on the finite values of ``column``; ``keys`` name a row uniquely.

    Trees draw their samples from a pool of ``trees * sample`` rows that the hash
    of the key picks, so the result does not depend on partitioning.
    The threshold is the exact quantile of the scores of *all* training rows: they
    are counted per step inside each partition and only the counts are shuffled.
    """
    finite = _finite(values, column)
    total = finite.count()
    if total == 0:
        return None
    pool = bottom_sample(values, keys, column, size=trees * sample, seed=seed)
    borders, scores = _grow(pool, total, trees, sample, seed)
    counts = finite.select(F.col(column).alias("v")).mapInPandas(_step_counter(borders), "step int, rows bigint")
    return Forest(borders, scores, _threshold(counts, scores, contamination))


def _grow(pool: DataFrame, total: int, trees: int, sample: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Step function of the forest that grows on a pool of (u, v)."""
    listed = (pool.agg(F.array_sort(F.collect_list(F.struct("u", "v"))).alias("pool"))
              .select(F.col("pool.v").alias("pool")))
    leaves = (pool.sparkSession.range(0, trees, 1, trees).withColumnRenamed("id", "tree")
              .withColumn("pool", listed.scalar())
              .mapInPandas(_tree_grower(sample, seed), "tree bigint, upper double, path double")).toPandas()
    return _step_function(leaves, trees, min(sample, total))


def _threshold(counts: DataFrame, scores: np.ndarray, contamination: float) -> float:
    """Quantile of the scores of all training rows, from rows per step."""
    rows = counts.groupBy("step").agg(F.sum("rows").alias("rows"))
    scored = rows.join(F.broadcast(counts.sparkSession.createDataFrame(
        pd.DataFrame({"step": np.arange(len(scores), dtype="int32"), "score": scores}))), "step")
    return float(scored.agg(F.percentile("score", 1.0 - contamination, F.col("rows"))).first()[0])


def _tree_grower(sample: int, seed: int):
    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for tree, pool in zip(batch["tree"], batch["pool"]):
                rng = np.random.default_rng([seed, int(tree)])
                drawn = rng.choice(np.asarray(pool), min(sample, len(pool)), replace=False)
                leaves = isolation_leaves(drawn, rng)
                yield pd.DataFrame({"tree": tree, "upper": [u for u, _ in leaves],
                                    "path": [p for _, p in leaves]})
    return grow


def _step_function(leaves: pd.DataFrame, trees: int, drawn: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean path over all trees on every interval between two borders, as a score."""
    uppers = leaves["upper"].to_numpy()
    borders = np.unique(uppers[np.isfinite(uppers)])
    ends = np.append(borders, np.inf)
    total = np.zeros(len(ends))
    for _, tree in leaves.groupby("tree", sort=True):
        ordered = tree.sort_values("upper")
        at = np.searchsorted(ordered["upper"].to_numpy(), ends, side="left")
        total += ordered["path"].to_numpy()[at]
    scale = path_adjustment(drawn) or 1.0
    return borders, np.power(2.0, -(total / trees) / scale)


def _step_counter(borders: np.ndarray):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = np.zeros(len(borders) + 1, dtype="int64")
        for batch in batches:
            steps = np.searchsorted(borders, batch["v"].to_numpy(), side="left")
            rows += np.bincount(steps, minlength=len(rows))
        used = np.flatnonzero(rows)
        yield pd.DataFrame({"step": used.astype("int32"), "rows": rows[used]})
    return count
