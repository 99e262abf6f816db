"""Exact histogram of encoded lengths, and what it answers for every context limit.

Documents are counted by the number of their token ids: each task combines its own rows, so
that the shuffle carries lengths, not documents. Suffix sums over the histogram give, for the
limit L, how many documents are longer, how many tokens fit, and how many are left when
every document is cut at L. They run in bands of lengths: totals of the bands first, then inside
each band, so that no task needs the histogram as a whole.

A null or empty text has length 0. Repeated rows count each. No rows give no lengths.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.text import chunks
from millrace.llm.tokens import encoder

BAND = 256


def histogram(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(length, documents) for every length that occurs."""

    def count(batches):
        for _, data, at in chunks(batches):
            length, documents = np.unique(encoder(vocabulary).lengths(data, at), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(length, pa.int64()),
                                              pa.array(documents, pa.int64())],
                                             ["length", "documents"])

    return (docs.select(F.col("text").cast("string")).mapInArrow(count, "length long, documents long")
            .groupBy("length").agg(F.sum("documents").alias("documents")))


def with_suffix_sums(counted: DataFrame, band: int = BAND) -> DataFrame:
    """Adds, for each length L taken as a limit: tokens, longer, tokens_longer (documents over
    L and their tokens), up_to, tokens_up_to, truncated (tokens when all are cut at L)."""
    rows = counted.select("length", "documents", (F.col("length") * F.col("documents")).alias("tokens"),
                          F.floor(F.col("length") / band).alias("band"))
    after = Window.orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding,
                                                       Window.unboundedFollowing)
    bands = rows.groupBy("band").agg(F.sum("documents").alias("d"), F.sum("tokens").alias("t"))
    bands = bands.select(
        "band", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"),
        F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"),
        F.sum("d").over(every).alias("d_all"), F.sum("t").over(every).alias("t_all"))
    inside = (Window.partitionBy("band").orderBy(F.desc("length"))
              .rowsBetween(Window.unboundedPreceding, -1))
    longer = F.coalesce(F.sum("documents").over(inside), F.lit(0)) + F.col("d_after")
    tokens = F.coalesce(F.sum("tokens").over(inside), F.lit(0)) + F.col("t_after")
    out = rows.join(bands, "band").select("length", "documents", "tokens", longer.alias("longer"),
                                          tokens.alias("tokens_longer"), "d_all", "t_all")
    return out.select(
        "length", "documents", "tokens", "longer", "tokens_longer",
        (F.col("d_all") - F.col("longer")).alias("up_to"),
        (F.col("t_all") - F.col("tokens_longer")).alias("tokens_up_to"),
        (F.col("t_all") - F.col("tokens_longer") + F.col("longer") * F.col("length")).alias("truncated"))


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, longer, truncated) for any limits, from with_suffix_sums()."""
    wanted = F.explode(F.array(*[F.lit(int(v)) for v in limits])).alias("context_limit")
    fits = F.col("length") <= F.col("context_limit")
    over = F.sum(F.when(~fits, F.col("documents")).otherwise(0))
    return (sums.select("length", "documents", "tokens", wanted).groupBy("context_limit")
            .agg(over.alias("longer"),
                 (F.sum(F.when(fits, F.col("tokens")).otherwise(0))
                  + over * F.col("context_limit")).alias("truncated")))


def quantile(sums: DataFrame, share: float):
    """Smallest length that at least this share of documents does not exceed."""
    return (sums.filter((F.col("up_to") >= F.lit(share) * (F.col("up_to") + F.col("longer"))))
            .agg(F.min("length")).first()[0])
