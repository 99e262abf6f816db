"""One query per operator over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import (decontaminate, exact_dedup as dedup, hard_negatives, jaccard, language,
                          line_dedup, packing, periodic, secrets_forest, shards, token_lengths, toxicity,
                          url_trust)
from millrace.llm.tables import staged, table
from millrace.llm.tokens import tokenizer_path
from millrace.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), str(sf_dir).rstrip("/"))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


@query
def op1_decontaminate(spark, sf):
    """Documents that hold test items, with the overlap found."""
    return decontaminate.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op2_shards(spark, sf):
    """Every document's place in 24 shards of near equal bytes."""
    return shards.shard(table(spark, sf, "documents"), 24)


@query
def op3_length_histogram(spark, sf):
    """Documents and tokens by encoded length, with suffix sums for every limit."""
    counted = staged(token_lengths.histogram(table(spark, sf, "documents"), tokenizer_path()),
                     "lengths")
    return token_lengths.with_suffix_sums(counted)


@query
def op4_jaccard_join(spark, sf):
    """Every document's set size, component of similar texts and number of links."""
    return jaccard.jaccard_join(table(spark, sf, "documents"))


@query
def op5_best_fit_packing(spark, sf):
    """Where every piece of every document lies in sequences of 4096 tokens."""
    return packing.pack(table(spark, sf, "documents"), tokenizer_path())


@query
def op6_exact_dedup(spark, sf):
    """Every document's group of equal texts and who stays."""
    docs = table(spark, sf, "documents")
    return dedup.exact_dedup(docs, dedup.earlier_half(docs))


@query
def op7_url_filter(spark, sf):
    """Every page's verdict by rule or by the trust of its host."""
    return url_trust.judge(table(spark, sf, "pages"))


@query
def op8_secret_scan(spark, sf):
    """Every candidate secret and how sure the forest is; two thirds of the rows teach."""
    return secrets_forest.scan(table(spark, sf, "documents"), tokenizer_path(),
                               F.crc32(F.col("doc_id").cast("string")) % 3 != 1)


@query
def op9_language(spark, sf):
    """Every document's language."""
    return language.identify(table(spark, sf, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query
def op10_toxicity(spark, sf):
    """Every document's toxicity score."""
    return toxicity.score(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op11_hard_negatives(spark, sf):
    """The best rows of other labels below each positive of every fiftieth row."""
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf, "embeddings"), relabelled, F.col("vec_id") % 50 == 0)


@query
def op12_line_dedup(spark, sf):
    """Every document's number of lines and what stays of them."""
    found = line_dedup.without_repeated_lines(table(spark, sf, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op13_periodic_runs(spark, sf):
    """Every document's runs of repeated words, the strongest one, and its text without them."""
    found = periodic.find_runs(periodic.with_cycles(table(spark, sf, "documents")))
    listed = F.expr("""array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')""")
    rows = found.withColumn("best", periodic.best_run())
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))
