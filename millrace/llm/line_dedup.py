"""Line dedup: lines that many documents hold stay in one document only.

Every line has a key: blanks stripped at both ends, A-Z lowered. Keys of ``min_chars`` code
points or more get a 128-bit hash (two 64-bit hashes, the second seeded with the first); only
hashes, ids and positions are shuffled. Hashes are range-partitioned and sorted by
document, largest doc_id first, and position: the first document of a hash keeps its lines, the
lines of all later ones go if the hash has ``min_docs`` documents. What comes back per
document is a bitmap of the lines it keeps, in words of 64 lines; words that keep every line
are left out, so most documents have none.

A hash held by a third of all documents would be one range. The most frequent hashes (at most
``HOT_KEYS``, and only those with ``HOT_LINES`` lines) are counted with partial sums instead, and
their lines are judged where they lie against a broadcast of one row per such hash. A hash that does
go through the ranges has fewer than 1/``HOT_KEYS`` of all lines, or fewer than ``HOT_LINES``.

All steps are DataFrame operations. Rows with one doc_id count as one document; repeated rows
(same doc_id, same text) get the same result. A null doc_id is one document that sorts below all
others. A null or empty text is one empty line. Texts of any length are read whole; an empty
table gives an empty result; columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.tables import documents, staged

MIN_CHARS, MIN_DOCS = 40, 5
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Broadcast of 40 bytes a hash, so under 1 MB.
HOT_KEYS, HOT_LINES = 20_000, 1_000
HASH = ["h1", "h2"]


def lines_of(text: str = "text") -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """Blanks off both ends, A-Z lowered; other letters stay as they are."""
    bare = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_key, pos, h1, h2 of every line whose key is long enough."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"),
                       F.posexplode(lines_of()).alias("pos", "line"))
    keyed = (rows.filter(F.octet_length("line") >= min_chars)
             .select("doc_id", "text_key", "pos", line_key(F.col("line")).alias("key"))
             .filter(F.char_length("key") >= min_chars)
             .withColumn("h1", F.xxhash64("key")))
    return keyed.select("doc_id", "text_key", "pos", "h1", F.xxhash64("h1", "key").alias("h2"))


def frequent(lines: DataFrame, hot_keys: int = HOT_KEYS, hot_lines: int = HOT_LINES) -> DataFrame:
    """h1, h2 of the hashes with the most lines; at most ``hot_keys`` rows."""
    return (lines.groupBy(*HASH).agg(F.count("*").alias("held")).filter(F.col("held") >= hot_lines)
            .orderBy(F.desc("held"), *HASH).limit(hot_keys).select(*HASH))


def dropped_lines(lines: DataFrame, min_docs: int = MIN_DOCS, hot_keys: int = HOT_KEYS,
                  hot_lines: int = HOT_LINES) -> DataFrame:
    """doc_id, text_key, pos of every line that goes; ``lines`` is a written table."""
    hot = staged(frequent(lines, hot_keys, hot_lines), "line-frequent")
    of_hot = lines.join(F.broadcast(hot), HASH)
    # One row per hash and document, then per hash: both with partial sums.
    judged = (of_hot.select(*HASH, "doc_id").distinct().groupBy(*HASH)
              .agg(F.count("*").alias("held_by"), F.max("doc_id").alias("keeper"))
              .filter(F.col("held_by") >= min_docs))
    from_hot = (of_hot.join(F.broadcast(judged), HASH)
                .filter(~F.col("doc_id").eqNullSafe(F.col("keeper"))))
    group = Window.partitionBy(*HASH)
    # dense_rank: rows of one document are one document; 1 is the keeper.
    streamed = (lines.join(F.broadcast(hot), HASH, "left_anti").repartitionByRange("h1")
                .sortWithinPartitions(*HASH, F.desc_nulls_last("doc_id"), "pos")
                .withColumn("place", F.dense_rank().over(
                    group.orderBy(F.desc_nulls_last("doc_id"))))
                .withColumn("last", F.max("place").over(group))
                .filter((F.col("place") > 1) & (F.col("last") >= min_docs)))
    columns = ["doc_id", "text_key", "pos"]
    return from_hot.select(*columns).union(streamed.select(*columns))


def keep_bitmaps(dropped: DataFrame) -> DataFrame:
    """doc_id, text_key, keep: (word, bits) for each 64 lines of a document that lose one; bit
    k of word w says that line 64 w + k stays."""
    bit = F.expr("shiftleft(1L, cast(pos % 64 as int))")
    return (dropped.withColumn("word", F.expr("cast(pos div 64 as int)"))
            .groupBy("doc_id", "text_key", "word").agg(F.bitwise_not(F.bit_or(bit)).alias("bits"))
            .groupBy("doc_id", "text_key")
            .agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("keep")))


def bitmaps_of(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
               hot_keys: int = HOT_KEYS, hot_lines: int = HOT_LINES) -> DataFrame:
    """The keep bitmaps of all documents that lose a line."""
    lines = staged(hashed_lines(documents(docs), min_chars), "line-hashes")
    return keep_bitmaps(dropped_lines(lines, min_docs, hot_keys, hot_lines))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, text with the lines that stay, n_lines before, n_dropped."""
    found = bitmaps.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "keep")
    held = documents(docs).withColumn("_of", F.xxhash64("text"))
    joined = held.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_of") == F.col("_key")),
                       "left")
    # Words by number, gaps filled, so that a line finds its bit without a search.
    dense = F.expr("""flatten(transform(keep, (entry, i) -> concat(
        array_repeat(-1L, entry.word - coalesce(get(keep, i - 1).word, -1) - 1), array(entry.bits))))""")
    rows = joined.withColumn("words", F.when(F.col("keep").isNotNull(), dense))
    rows = rows.withColumn("lines", lines_of())
    stays = F.expr("""filter(lines, (line, i) ->
        coalesce(get(words, cast(i div 64 as int)), -1L) & shiftleft(1L, cast(i % 64 as int)) <> 0)""")
    kept = F.when(F.col("words").isNull(), F.col("lines")).otherwise(stays)
    return (rows.withColumn("kept", kept)
            .select("doc_id", F.array_join("kept", "\n").alias("text"),
                    F.size("lines").cast("long").alias("n_lines"),
                    (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped")))


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                           hot_keys: int = HOT_KEYS, hot_lines: int = HOT_LINES) -> DataFrame:
    """doc_id, text that stays, n_lines, n_dropped of every row of ``docs``."""
    return apply_bitmaps(docs, bitmaps_of(docs, min_chars, min_docs, hot_keys, hot_lines))
