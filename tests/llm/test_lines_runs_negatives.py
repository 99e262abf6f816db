import hashlib
import math
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import odd
import pytest
from pyspark.sql import functions as F

from millrace.llm import hard_negatives, line_dedup, periodic
from millrace.llm.queries import QUERIES
from millrace.llm.text import mix

BLANKS = "\t\n\x0b\x0c\r "


# Line dedup

def key_of(line):
    return re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(BLANKS))


def kept_lines(rows):
    """(text that stays, lines before, lines dropped) of each (doc_id, text)."""
    held = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= 40:
                held[key_of(line)].add(i)
    top = {k: max(ids, key=lambda i: (i is not None, i or 0)) for k, ids in held.items() if len(ids) >= 5}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if key_of(x) not in top or top[key_of(x)] == i]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return out


def line_rows():
    draw = random.Random(3)
    common = [odd.prose(700 + k, 18) for k in range(6)] + ["é" * 41, "ß" * 39, "É" * 30 + "x" * 12]
    rows = []
    for k in range(60):
        lines = [odd.prose(k * 100 + j, draw.randint(0, 20)) for j in range(draw.randint(1, 6))]
        for j, line in enumerate(common):
            if k % (j + 2) == 0:
                shown = line.upper() if k % 3 == 0 and line.isascii() else line
                lines.insert(draw.randint(0, len(lines)), draw.choice(BLANKS.replace("\n", "")) * (k % 4) + shown)
        rows.append((k - 5, "\n".join(lines)))
    long = "\n".join([common[1], "short"] * 150)  # many words of the bitmap, every other line goes
    rows += [(-100, long), (-100, long), (-100, odd.prose(1, 9)), (None, common[1] + "\n\n" + common[2]),
             (None, None), (None, ""), (7000, "\n"), (7001, common[4]), (7001, common[4] + " ")]
    return rows + [(i, t) for i, t, *_ in odd.rows()]


@pytest.mark.parametrize("hot_keys, hot_lines", [(20_000, 1_000), (2, 3), (100, 1)])
def test_line_dedup(spark, hot_keys, hot_lines):
    rows = line_rows()
    clash = "doc_id long, text string, h1 long, pos int, keep string, line string, text_key long, words int"
    docs = spark.createDataFrame([(i, t, 1, 2, "k", "l", 3, 4) for i, t in rows], clash)
    got = line_dedup.without_repeated_lines(docs, hot_keys=hot_keys, hot_lines=hot_lines)
    got = [(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()]
    want = kept_lines(rows)
    assert sum(r[3] for r in want) > 300
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_line_bitmaps_hold_only_what_loses_a_line(spark):
    rows = [(k, "\n".join(["own line %d %s" % (k, "x" * 40)] * 70 + ["common " + "y" * 40])) for k in range(6)]
    found = line_dedup.bitmaps_of(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: [(k["word"], k["bits"]) for k in r["keep"]] for r in found} == {
        k: [(1, ~(1 << 6))] for k in range(5)}


def test_line_dedup_of_nothing(spark):
    assert line_dedup.without_repeated_lines(odd.empty(spark)).count() == 0


def test_line_ranges_need_one_shuffle(spark):
    lines = line_dedup.hashed_lines(spark.createDataFrame(line_rows(), "doc_id long, text string"))
    plan = line_dedup.dropped_lines(lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning(h1") == 1 and "Python" not in plan and "Cartesian" not in plan


# Periodic runs

def runs_by_force(w):
    n, found = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= 4 * q:
                found.setdefault((i, j + q), q)
            i = j
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic_words(draw):
    k, n = draw.choice([1, 2, 2, 3, 20]), draw.choice([0, 1, 5, 20, 60, 150])
    w = [draw.randrange(k) for _ in range(n)]
    if n and draw.random() < .7:
        p, a = draw.randint(1, max(1, n // 4)), draw.randrange(n)
        for i in range(a, min(n, a + draw.randint(1, n))):
            w[i] = w[a + (i - a) % p]
    if n > 20 and draw.random() < .5:
        unit = [draw.randrange(2) for _ in range(draw.randint(1, 3))] * 9
        w[5:5 + len(unit)] = unit
        w = (w[:draw.randint(5, 30)] * 5)[:n]
    return w


def test_runs_against_brute_force():
    draw = random.Random(11)
    for _ in range(600):
        docs = [periodic_words(draw) for _ in range(draw.randint(1, 5))]
        first = np.cumsum([0] + [len(d) for d in docs])
        code = mix(np.array([x for d in docs for x in d], np.uint64) + np.uint64(7))
        got = [tuple(map(int, r)) for r in periodic.runs_of(code, first)]
        want = [(s + int(f), e + int(f), q) for d, f in zip(docs, first) for s, e, q in runs_by_force(d)]
        assert got == want


def test_chosen_positions_depend_on_content_alone():
    draw = np.random.default_rng(4)
    for scale in (2, 4, 8):
        part = draw.integers(0, 50, 400)
        names = []
        for before in (0, 37):
            code = mix(np.concatenate([draw.integers(50, 90, before), part]).astype(np.uint64))
            name = code
            step = 1
            while step < scale:
                name = mix(name + periodic._ahead(name, step) * np.uint64(3))
                step *= 2
            names.append(periodic._chosen(name, scale, None) - before)
        inside = [set(x[(x >= 0) & (x <= 400 - 2 * scale)].tolist()) for x in names]
        assert inside[0] == inside[1]
        # Without small periods, any ``scale`` neighbours hold a chosen position.
        gaps = np.diff(sorted(inside[0]))
        assert gaps.max() <= scale and len(inside[0]) < 400


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def collapsed(w, runs):
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def run_texts():
    draw = random.Random(5)
    texts = [" ".join("w%d" % x for x in periodic_words(draw)) for _ in range(80)]
    return texts + ["a " * 5, "a\x0ba a\ta a\n a", "a b " * 4, "a b a b a b a", "A a " * 6, "é " * 9,
                    "x y " * 3000, odd.prose(9, 3000) + " " + (odd.prose(8, 700) + " ") * 5, None, "", "  "]


def test_find_runs(spark):
    texts = run_texts()
    rows = [(k, t) for k, t in enumerate(texts)] + [(3, texts[3])] * 2 + [(None, "b " * 7)]
    rows += [(i, t) for i, t, *_ in odd.rows() if len(t or "") < 20_000]
    frame = spark.createDataFrame([(i, t, 1, "r", 5) for i, t in rows],
                                  "doc_id long, text string, n_words int, runs string, start int")
    got = sorted(((r["doc_id"], r["n_words"], [(x["start"], x["length"], x["period"]) for x in r["runs"]], r["text"])
                  for r in periodic.find_runs(frame).collect()), key=repr)
    want = []
    for i, t in rows:
        w = words_of(t)
        runs = [r for r in runs_by_force(w) if r[1] - r[0] >= 6]
        want.append((i, len(w), [(s, e - s, q) for s, e, q in runs], collapsed(w, runs)))
    assert got == sorted(want, key=repr)
    assert periodic.find_runs(odd.empty(spark)).count() == 0


def test_long_text_is_split_in_pieces():
    text = (odd.prose(2, 900) + "  \t" + "x" * 3000 + "\n" + odd.prose(3, 400)).encode()
    data = np.frombuffer(text, np.uint8)
    whole = periodic.words(data, np.array([0, len(data)]), lower=False)
    cut = periodic.words_in_pieces(data, np.array([0, len(data)]), size=700)
    assert all((a == b).all() for a, b in zip(whole, cut))


def altered(i, w):
    n = len(w)
    if i is None or not n:
        return w
    h = zlib.crc32(str(i).encode())
    if h % 10:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[a + (k - a) % p] if k >= a else w[k] for k in range(n)]


def test_periodic_query(spark, tmp_path):
    rows = [(k, odd.prose(k, 3 * (k % 90))) for k in range(300)]
    rows += [(1000 + k, t) for k, t in enumerate(run_texts())] + [(None, "a " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["doc_id"], r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"], r["runs_sha256"],
            r["collapsed_sha256"]) for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()}
    want, planted = set(), 0
    for i, t in rows:
        w = altered(i, words_of(t))
        planted += w != words_of(t)
        runs = [r for r in runs_by_force(w) if r[1] - r[0] >= 6]
        best = min(runs, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]), default=None)
        four = (None,) * 4 if best is None else (
            best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2])
        listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
        want.add((i, len(runs), *four, hashlib.sha256(listed.encode()).hexdigest(),
                  hashlib.sha256(collapsed(w, runs).encode()).hexdigest()))
    assert planted > 20 and got == want


# Hard negatives

def test_scores_are_inner_products():
    draw = np.random.default_rng(6)
    for dims, low, high in ((1, -3, 4), (8, 0, 1), (13, -256, 256), (64, -200, 200), (20, -1 << 20, 1 << 20), (0, 0, 1)):
        a, c = draw.integers(low, high, (7, dims)), draw.integers(low, high, (50, dims))
        got = hard_negatives.scores(hard_negatives.subset_sums(a), hard_negatives.bit_planes(c))
        assert (got == a @ c.T).all()


def vectors():
    draw = random.Random(8)
    rows = [(k, [draw.gauss(0, .15) for _ in range(12)], draw.randrange(3)) for k in range(160)]
    common = [0.25] * 12
    rows += [(200 + k, common, k % 3) for k in range(60)]  # a third are one vector
    rows += [(50, [0.3] * 12, 0), (50, [0.1] * 12, 0), (61, common, 0), (61, common, 0), (300, None, 1), (301, common, None),
             (302, [0.1, None], 1), (303, [0.1, math.nan], 1), (304, [math.inf] * 12, 1), (None, common, 1),
             (305, [], 1), (306, [0.4] * 3, 2), (307, [1e30, -1e30], 0), (350, [0.5], 2), (400, [-0.5] * 12, 9)]
    return rows


def negatives_by_force(rows):
    usable = []
    for k, (i, v, label) in enumerate(rows):
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        usable.append((k, i, label, [max(-(1 << 20), min((1 << 20) - 1, math.floor(256 * x))) for x in v]))
    out = []
    for k, i, label, v in usable:
        if i % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(v, u)), j, other, at) for at, j, other, u in usable]
        same = sorted((s, j) for s, j, other, at in scored if other == label and at != k)[:5]
        for s, j in same:
            fits = sorted((t, m) for t, m, other, _ in scored
                          if other != label and 50 * -s <= 100 * -t <= 95 * -s)[:3]
            out += [(i, j, r + 1, m, -s, -t) for r, (t, m) in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize("group, slab", [(128, 1 << 20), (2, 40)])
def test_hard_negatives(spark, group, slab):
    rows = vectors()
    clash = "vec_id long, embedding array<double>, label int, row int, score int, numbers string, bands int"
    frame = spark.createDataFrame([(*r, 1, 2, "n", 3) for r in rows], clash)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.mine(frame, label, F.col("vec_id") % 50 == 0, group=group, slab=slab)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = negatives_by_force(rows)
    assert len(want) > 40 and sorted(tuple(r) for r in found.collect()) == want
    assert hard_negatives.mine(frame.limit(0), label, F.col("vec_id") % 50 == 0).count() == 0
