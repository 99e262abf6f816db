"""Rows every operator must take: nulls, empty and long texts, repeats, clashing columns."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, place long, digest string, "
          "n long, key string, size long, node int, rep long, word string, rank long")
SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe ri so tu va we xi yo zu".split()


def prose(seed, count):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(SYLLABLES, k=draw.randint(1, 4))) for _ in range(count))


def rows():
    base = prose(1, 120)
    near = " ".join(base.split()[:-2]) + " mufo zuna"
    texts = [(0, base), (1, base), (2, base.upper()), (3, near), (4, None), (5, ""), (6, " \t\n "),
             (7, "one"), (8, "One"), (9, "two words"), (10, prose(2, 30_000)), (11, "x" * 5000),
             (12, prose(3, 200)), (12, prose(3, 200)), (None, prose(4, 50)), (None, base),
             (13, "é" * 40 + " ß 漢字 <|endoftext|> a\x1cb"), (14, "12345 !!! ..."), (-5, prose(5, 80))]
    return [(i, t, "en" if k % 2 else None, f"s{k % 3}", None, k, "d", 1, "k", 2, 3, 4, "w", 5)
            for k, (i, t) in enumerate(texts)]


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
