import random
from collections import Counter, defaultdict
from math import log

import numpy as np
import odd
import pytest
from pyspark.sql import functions as F

from millrace.llm import toxicity
from millrace.llm.text import PUNCT, words


def corpus(seed=2, rows=160):
    draw = random.Random(seed)
    usual, bad = [f"w{k}" for k in range(60)], ["grumpf", "skazz", "blit"]
    out = []
    for k in range(rows):
        text = [draw.choice(usual) for _ in range(draw.randint(0, 40))]
        if k % 3 == 0:
            for _ in range(4):
                text.insert(draw.randint(0, len(text)), draw.choice(bad))
        out.append((" ".join(text) + draw.choice(["", " Once-%d" % k]), int(k % 3 == 0)))
    return out


def ratios_by_force(rows):
    """log P_toxic - log P_ordinary of every word of the corpus, from the definition."""
    before, held = defaultdict(set), defaultdict(set)
    for k, (text, toxic) in enumerate(rows):
        w = [x for x in "".join(c if c.isalnum() else " " for c in text.lower()).split()]
        for a, b in zip([None, *w], w):
            before[toxic, b].add(a)
        for x in set(w):
            held[x].add(k)
    n = {c: Counter({w: len(s) for (d, w), s in before.items() if d == c}) for c in (0, 1)}
    total = {c: sum(n[c].values()) for c in (0, 1)}
    size, spoken = min(total.values()), sum(map(len, held.values()))
    over = {c: {w: max(n[c][w] * size / total[c] - toxicity.DISCOUNT, 0) / size for w in held if len(held[w]) > 1}
            for c in (0, 1)}
    rest = {c: 1 - sum(over[c].values()) for c in (0, 1)}
    plain = log(rest[1] / rest[0])
    out = {}
    for w, ids in held.items():
        own = len(ids) > 1 and (over[0][w] > 0 or over[1][w] > 0)
        p = [over[c].get(w, 0) + rest[c] * len(ids) / spoken for c in (0, 1)]
        out[w] = log(p[1] / p[0]) if own else plain
    return out, plain


@pytest.mark.parametrize("piece", [1 << 22, 7])
def test_ratios_are_those_of_the_definition(spark, piece):
    rows = corpus()
    model = toxicity.learn(spark.createDataFrame(rows, "text string, toxic int").repartition(5), piece)
    want, plain = ratios_by_force(rows)
    assert model.plain == pytest.approx(plain) and (len(model.pieces) > 3) == (piece == 7)
    for w, ratio in want.items():
        raw = np.frombuffer(w.encode(), np.uint8)
        found = words(raw, np.array([0, len(raw)]), PUNCT)
        x = toxicity.figures(model.pieces[0], found)
        for other in model.pieces[1:]:
            x = x.plus(toxicity.figures(other, found))
        assert x.features(np.array([1]), model.plain)[0] == pytest.approx([ratio, ratio]), w
    assert want["grumpf"] > 1 and len({round(r, 9) for r in want.values()}) > 20


def test_rank_in_the_corpus_does_not_decide(spark):
    # The same expressions among few and among very many other words.
    few = corpus()
    many = few + [(" ".join(f"filler{k}x{j} filler{k}x{j}" for j in range(40)), k % 2) for k in range(400)] * 2
    one, two = (toxicity.learn(spark.createDataFrame(r, "text string, toxic int")) for r in (few, many))
    raw = np.frombuffer(b"grumpf", np.uint8)
    found = words(raw, np.array([0, 6]), PUNCT)
    ratio = [toxicity.figures(m.pieces[0], found).total[0] - m.plain for m in (one, two)]
    assert min(ratio) > 1


def test_pieces_give_the_same_scores(spark):
    rows = corpus(3, 300)
    frame = spark.createDataFrame([(k, t, "c", 1) for k, (t, _) in enumerate(rows)],
                                  "doc_id long, text string, _known string, _total int")
    labels = spark.createDataFrame([(k, y) for k, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    whole, cut = ({r["doc_id"]: (r["score"], r["predicted"]) for r in
                   toxicity.score(frame, labels, piece=p).collect()} for p in (1 << 22, 5))
    assert cut.keys() == whole.keys()
    assert all(cut[k] == (pytest.approx(whole[k][0], rel=1e-6), whole[k][1]) for k in whole)
    bad = [k for k, (_, y) in enumerate(rows) if y and k % 2]
    assert np.mean([whole[k][1] for k in bad]) > 0.9
    kept = toxicity.without_toxic(frame, labels, piece=5)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k, (_, p) in whole.items() if not p}


def test_curve_is_drawn_from_both_classes(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "CURVE_ROWS", 40)
    rows = corpus(5, 900)
    frame = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    found = toxicity.score(frame, labels).filter("held_out").collect()
    right = np.mean([r["predicted"] == rows[r["doc_id"]][1] for r in found])
    assert right > 0.9
    assert toxicity.score(odd.empty(spark), labels).count() == 0


def given_by_force(rows, text):
    """Mean log P_toxic(w | h) - log P_ordinary(w | h) of a text, from the definition."""
    pairs, cells = {0: Counter(), 1: Counter()}, [x.lower().replace("-", " ").split() for x, _ in rows]
    for w, (_, toxic) in zip(cells, rows):
        pairs[toxic].update(set(zip([None, *w], w)))
    held = Counter(x for w in cells for x in set(w))
    n = {c: Counter(w for _, w in pairs[c]) for c in (0, 1)}
    total, spoken = {c: len(pairs[c]) for c in (0, 1)}, sum(held.values())
    factor = {c: min(sum(p.values()) for p in pairs.values()) / sum(pairs[c].values()) for c in (0, 1)}
    size = min(total.values())
    over = {c: {w: max(n[c][w] * size / total[c] - toxicity.DISCOUNT, 0) / size for w in held if held[w] > 1} for c in (0, 1)}
    rest = {c: 1 - sum(over[c].values()) for c in (0, 1)}

    def given(c, h, w):
        after = sum(k for (a, _), k in pairs[c].items() if a == h) * factor[c]
        kept = {b: max(k * factor[c] - toxicity.DISCOUNT, 0) for (a, b), k in pairs[c].items() if a == h}
        # Words with no ratio of their own: both classes say the same but for what they leave.
        low = over[c].get(w, 0) + rest[c] * (held[w] / spoken if w in held else 1)
        return (kept.get(w, 0) + (after - sum(kept.values())) * low) / after if after else low

    w = text.split()
    return np.mean([log(given(1, h, x) / given(0, h, x)) for h, x in zip([None, *w], w)])


def test_words_are_given_the_word_before(spark):
    rows = corpus(7, 200)
    rows += [("grumpf skazz w1", 1)] * 9 + [("w1 w2 w3", 0)] * 30
    model = toxicity.learn(spark.createDataFrame(rows, "text string, toxic int").repartition(5), 7)
    assert sum(len(p.pair) for p in model.pieces) > 5
    for text in ("grumpf skazz w1", "skazz grumpf w1", "w1 w2 w3", "w3 never w2 w1 grumpf", "blit"):
        raw = np.frombuffer(text.encode(), np.uint8)
        found = words(raw, np.array([0, len(raw)]), PUNCT)
        x = toxicity.figures(model.pieces[0], found)
        for other in model.pieces[1:]:
            x = x.plus(toxicity.figures(other, found))
        assert x.likelihood(np.diff(found.first), model.plain)[0] == pytest.approx(given_by_force(rows, text)), text
