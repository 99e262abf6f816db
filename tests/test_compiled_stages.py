"""Steps that all rows of a run pass are neither interpreted nor sorted."""

import random

from pyspark.sql import functions as F

from millrace.operators.dedupe import _first_of_keys, duplicate_report
from millrace.session import configure


def test_stages_beyond_what_the_jvm_compiles_are_not_fused(spark):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    configure(spark)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8_000


def _rows(spark):
    draw = random.Random(4)
    rows = [(f"h{draw.randint(0, 40)}", draw.randint(1, 3), draw.choice([None, *range(1, 60)]),
             draw.choice(["a", "b", None]), f"id{k}") for k in range(600)]
    shape = "record_hash string, source_rank int, pos long, source string, record_id string"
    return spark.createDataFrame(rows, shape).repartition(5)


def test_first_rows_are_those_of_the_definition(spark):
    rows = _rows(spark)
    want = rows.groupBy("record_hash").agg(F.min(F.struct("source_rank", "pos", "source")).alias("_first"),
                                           F.count(F.lit(1)).alias("_copies"))
    assert sorted(_first_of_keys(rows).collect()) == sorted(want.collect())


def test_rows_are_combined_before_any_sort(spark):
    plan = duplicate_report(_rows(spark))._jdf.queryExecution().sparkPlan().toString()
    low = [line for line in plan.split("\n") if "Aggregate(" in line][-1]
    assert "HashAggregate" in low and "source_rank" in low
