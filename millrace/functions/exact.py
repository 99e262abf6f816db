"""Exact mean and deviation of doubles, the same to the last bit in any order and partitioning.

A finite double is a whole number of at most 53 bits times a power of two. Numbers are grouped by bands of
``BAND`` powers. In a band all are whole multiples of one unit, below 2^58 of it, so they add up as whole
numbers; so do their squares, as products of the upper and lower 29 bits. Sums of bands add up over
partitions, sources and runs, and are put together as whole numbers of any size.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from fractions import Fraction
from typing import NamedTuple

from pyspark.sql import Column, Row, functions as F

BAND, HALF = 4, 1 << 29
LOWEST = -1074  # the smallest power of two of a double
SUMS = ("total", "high", "mixed", "low")


class Moments(NamedTuple):
    """Number of values, mean, and standard deviation of the population; None without values."""

    n: int
    mean: float | None
    std: float | None


def band_of(value: Column) -> Column:
    """Number of the band; null for nulls and numbers that are not finite."""
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    # The logarithm may be off by one next to a power of two: units leave room for it.
    power = F.when(value == 0, 0).otherwise(F.floor(F.log2(F.abs(value))))
    return F.when(finite, F.greatest(F.floor(power / BAND), F.lit(LOWEST // BAND)).cast("int"))


def unit_of(band: int) -> int:
    """Power of two of a band's unit."""
    return max(BAND * band - 53, LOWEST)


def band_sums(value: Column, band: Column) -> list[Column]:
    """Sums over the values of one band: n, the multiples of the unit, and the three parts of their
    squares. Group by ``band``, a column of band_of()."""
    unit = F.greatest(band * BAND - 53, F.lit(LOWEST))
    # Twice half the power, since the whole one can be out of range.
    half = F.floor(unit / 2)
    whole = F.when(band.isNotNull(), (value * F.pow(F.lit(2.0), -half) * F.pow(F.lit(2.0), half - unit))
                   .try_cast("bigint"))
    upper = F.shiftright(whole, 29)
    lower = whole - F.shiftleft(upper, 29)
    added = {"total": whole, "high": upper * upper, "mixed": upper * lower, "low": lower * lower}
    return [F.count(whole).alias("n"),
            *[F.coalesce(F.sum(c.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias(name)
              for name, c in added.items()]]


def moments_of(bands: Iterable[Row]) -> Moments:
    """Moments from rows (band, n, total, high, mixed, low); several rows of a band add up."""
    n, total, squares = 0, 0, 0
    for row in bands:
        if row["band"] is None or not row["n"]:
            continue
        t, high, mixed, low = (int(row[c]) for c in SUMS)
        # In units of the smallest double, and of its square.
        shift = unit_of(row["band"]) - LOWEST
        n += row["n"]
        total += t << shift
        squares += (high * HALF * HALF + 2 * mixed * HALF + low) << 2 * shift
    if not n:
        return Moments(0, None, None)
    mean = float(Fraction(total, n) * Fraction(1, 1 << -LOWEST))
    spread = Fraction(n * squares - total * total, n * n)
    return Moments(n, mean, _root(spread))


def _root(squares: Fraction) -> float:
    """Square root, in units of the smallest double, to the last bit."""
    top, bottom = squares.numerator, squares.denominator
    if not top:
        return 0.0
    # As many bits as a double has and more, by a whole root.
    bits = max(0, 140 - (top.bit_length() - bottom.bit_length()))
    bits += bits % 2
    root = math.isqrt((top << bits) // bottom)
    return float(Fraction(root, 1 << bits // 2) * Fraction(1, 1 << -LOWEST))
