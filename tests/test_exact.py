import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from millrace.functions.exact import band_of, band_sums, moments_of


def exact(values):
    rows = [Fraction(v) for v in values]
    mean = sum(rows) / len(rows)
    return float(mean), sum((v - mean) ** 2 for v in rows) / len(rows)


def measured(frame):
    rows = frame.withColumn("band", band_of(F.col("v")))
    return moments_of(rows.groupBy("band").agg(*band_sums(F.col("v"), F.col("band"))).collect())


@pytest.mark.parametrize("name", ["money", "far", "tiny", "mixed", "equal", "powers"])
def test_moments_are_exact(spark, name):
    draw = random.Random(4)
    values = {
        "money": [round(draw.uniform(-900, 90_000), 2) for _ in range(3_000)],
        "far": [1e15 + draw.random() for _ in range(500)],
        "tiny": [5e-324, -5e-324, 2.2e-308, 1e-300, 3e-310, 0.0],
        "mixed": [1.7e308, -1.7e308, 1.0, -0.0, 1e-200, 123456789.123],
        "equal": [0.1] * 77,
        "powers": [s * 2.0 ** k * (1 + e) for k in range(-60, 60) for s in (1, -1) for e in (0, 2.0 ** -52)],
    }[name]
    rows = [(v,) for v in values] + [(None,), (math.nan,), (math.inf,), (-math.inf,)]
    frame = spark.createDataFrame(rows, "v double")
    one, two = measured(frame.coalesce(1)), measured(frame.repartition(13))
    assert one == two
    mean, variance = exact(values)
    assert (one.n, one.mean) == (len(values), mean)
    # The root is right to the last bit: its neighbours are farther off.
    def off(x):
        return abs(Fraction(x) ** 2 - variance)
    assert off(one.std) <= off(math.nextafter(one.std, math.inf)) and off(one.std) <= off(math.nextafter(one.std, 0.0))


def test_moments_of_nothing(spark):
    assert tuple(measured(spark.createDataFrame([(None,)], "v double"))) == (0, None, None)
