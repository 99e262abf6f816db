"""From raw documents to packed sequences: toxicity, exact copies, near copies, test items, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what a stage keeps is written
and read again before the next one. All stages but the last return the columns of ``docs``.

The stages that remove copies give every row a number that its doc_id and text decide (64 bits), and
decide by number: of equal or near equal rows one stays, whatever ids they have, and rows that share an
id but not their text are judged apart. Texts that are null or have no words are equal to each
other in the second stage and like nothing in the others; of rows with the same doc_id and text
one stays. Empty tables pass through all stages; columns of any name are kept.

Python tasks get whole texts in batches of ``BATCH_ROWS`` rows: Spark's 10,000 are 20 MB and more in the
JVM and again in the worker, which keeps what it once had for as long as it lives, over all stages.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import decontaminate, exact_dedup, jaccard, packing, toxicity
from millrace.llm.tables import staged, table
from millrace.llm.tokens import tokenizer_path
from millrace.session import configure

BATCH_ROWS = 1_000


def stage(fn: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """A stage that sets the session up itself, so that it may also be called alone."""

    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        return fn(spark, docs, sf_dir)

    return run_stage


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with their numbers, and the name of that column, which ``docs`` does not have."""
    name, taken = "_row", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return docs.withColumn(name, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))), name


def _without(rows: DataFrame, name: str, dropped: DataFrame) -> DataFrame:
    """One row of each number that is not in ``dropped`` (one column, row), without the number. Only where
    rows are repeated do texts go through an aggregate, in which copies meet as one per task."""
    if not rows.groupBy(name).count().filter("count > 1").isEmpty():
        rows = rows.dropDuplicates([name])
    return rows.join(dropped.select(F.col("row").alias(name)), name, "left_anti").drop(name)


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


@stage
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the most characters, then the smallest doc_id."""
    rows, name = _numbered(docs)
    return _without(rows, name, exact_dedup.copies_of_rows(rows, name, exact_dedup.earlier_half(docs)))


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect, the one with the smallest doc_id."""
    rows, name = _numbered(docs)
    ids = rows.select(F.col(name).alias("row"), F.col("doc_id").cast("long").alias("own")).distinct()
    found = staged(jaccard.jaccard_components(rows.select(F.col(name).alias("doc_id"), "text"))
                   .select(F.col("doc_id").alias("row"), "component_id").distinct(), "stage-components")
    # Rows without a link are their own component. A null doc_id comes last.
    place = F.struct(F.col("own").isNull(), "own", "row")
    linked = found.join(found.filter("row <> component_id").select("component_id").distinct(), "component_id")
    stays = (linked.join(ids, "row").groupBy("component_id").agg(F.min_by("row", place).alias("stays")))
    dropped = linked.join(stays, "component_id").filter("row <> stays").select("row")
    return _without(rows, name, dropped)


@stage
def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_test_items),
    ("best-fit packing", pack_sequences),
]

# Learned scores and token ids are beyond SQL: the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = staged(step(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
