import re
from collections import defaultdict

import numpy as np
import odd
import pytest
from pyspark.sql import functions as F

from millrace.llm import decontaminate as leaks, language, secrets_forest as secrets, toxicity
from millrace.llm.tokens import tokenizer_path


def items():
    long = odd.prose(900, 150)
    return [(1, odd.prose(901, 30) + ". " + odd.prose(902, 8) + "."), (2, odd.prose(903, 14)),
            (3, long), (4, "too short"), (5, None), (None, odd.prose(904, 20)), (2, odd.prose(905, 25))]


def test_leaks_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(leaks, "SHARD", 2)
    monkeypatch.setattr(leaks, "BLOCK", 2)
    bench = spark.createDataFrame(items(), "item_id long, text string")
    rows = odd.rows()
    hidden = [(100, odd.prose(50, 300) + " " + items()[0][1].upper() + "\n" + odd.prose(51, 90)),
              (101, items()[1][1]), (102, odd.prose(52, 37) + " " + items()[2][1]),
              (103, " ".join(items()[0][1].split()[:12]) + " " + odd.prose(53, 40)),
              (104, items()[6][1] + " " + items()[1][1]), (105, items()[5][1]), (106, items()[0][1][:-1])]
    docs = odd.frame(spark).select("doc_id", "text").union(
        spark.createDataFrame(hidden, "doc_id long, text string"))

    def runs(text):
        words = re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())
        return {tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2))} if words else set()

    want = set()
    for doc, text in [(r[0], r[1]) for r in rows] + hidden:
        own = runs(text)
        for item, body in items():
            if item is not None and body and len(body.split()) >= leaks.FEWEST:
                q, a = leaks.question_and_answer(body)
                if all(len(runs(p) & own) >= leaks.OVERLAP * len(runs(p)) for p in (q, a)):
                    want.add((doc, item))
    found = leaks.find_leaks(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want
    assert {100, 101, 102, 104, 106} == {d for d, _ in want}
    kept = leaks.without_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - 5


def test_leaks_of_nothing(spark):
    bench = spark.createDataFrame(items(), "item_id long, text string")
    assert leaks.find_leaks(odd.empty(spark), bench).count() == 0
    assert leaks.find_leaks(odd.frame(spark), bench.limit(0)).count() == 0
    assert leaks.without_leaks(odd.frame(spark), bench.limit(0)).count() == len(odd.rows())


def test_block_maxima_bound_every_score():
    entries = [(k, odd.prose(700 + k, 20 + k), leaks._codes([odd.prose(700 + k, 20 + k)]).hash)
               for k in range(20)]
    term = np.unique(np.concatenate([e[2] for e in entries]))
    shard = leaks._shard(entries, term, np.ones(len(term)), 30.0)
    for b, block in enumerate(shard.blocks):
        assert (shard.most[block.term, b] >= block.weight.max(axis=1) - 1e-6).all()
    for _, _, code in entries[:5]:  # an entry scores 1 against itself
        place = np.unique(np.searchsorted(shard.term, code))
        best = max(b.weight[np.isin(b.term, place)].sum(axis=0).max() for b in shard.blocks)
        assert best == pytest.approx(1, abs=1e-4)


def labelled(n):
    bad = ["vilo zunk", "grumpf", "skazz"]
    docs, labels = [], []
    for k in range(n):
        words = odd.prose(3000 + k, 40).split()
        toxic = k % 4 == 0
        if toxic:
            for j, w in enumerate(bad):
                words.insert((7 * k + 11 * j) % len(words), w)
        docs.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    return docs, labels


def test_toxicity(spark):
    docs, labels = labelled(400)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in toxicity.score(frame, known).collect()}
    held = [found[k] for k, _ in docs if found[k]["held_out"]]
    assert 80 < len(held) < 190
    right = np.mean([r["predicted"] == (r["doc_id"] % 4 == 0) for r in held])
    assert right > 0.95
    # Labels of rows held out change nothing.
    flipped = known.withColumn("toxic", F.when(toxicity.learnable(F.col("doc_id")), F.col("toxic"))
                               .otherwise(1 - F.col("toxic")))
    again = {r["doc_id"]: r["score"] for r in toxicity.score(frame, flipped).collect()}
    assert all(abs(again[k] - found[k]["score"]) < 1e-12 for k in again)
    kept = toxicity.without_toxic(frame, known)
    assert {r["doc_id"] for r in kept.collect()} == {
        k for k, r in found.items() if r["predicted"] == 0}


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(0, 1), (1, 0), (3, None), (None, 1), (10, 1), (12, 0), (12, 1)],
                                   "doc_id long, toxic int")
    found = toxicity.score(odd.frame(spark), labels)
    assert found.count() == len(odd.rows())
    assert all(0 <= r["score"] <= 1 for r in found.collect())
    assert toxicity.score(odd.empty(spark), labels).count() == 0
    none = toxicity.score(odd.frame(spark), labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.0}
    kept = toxicity.without_toxic(odd.frame(spark), labels.limit(0))
    assert kept.count() == len(odd.rows()) and kept.columns == odd.frame(spark).columns


def test_language_forward_sums_all_segmentations():
    piece, size = language.vocabulary(tokenizer_path("piece_bpe_32k.model"))
    rng = np.random.default_rng(1)
    model = language.Model(["a", "b"], piece, rng.random((len(piece), 2)))
    text = np.frombuffer(b"the cats", np.uint8)
    got = language.word_scores(model, text, np.array([0, 4]), np.array([3, 8]))

    def total(word, lang):
        sums = [1.0] + [0.0] * len(word)
        for end in range(1, len(word) + 1):
            for start in range(max(0, end - language.PIECE_BYTES), end):
                raw = np.frombuffer(word[start:end], np.uint8)
                code = language._range_hash(language._prefix(raw), np.array([0]), np.array([len(raw)]))
                at = np.searchsorted(piece, code)[0]
                if at < len(piece) and piece[at] == code[0]:
                    sums[end] += sums[start] * model.weight[at, lang]
        return np.log(sums[-1]) - len(word) * np.log(language.SCALE)

    for k, word in enumerate((b" the", b" cats")):
        for lang in range(2):
            assert got[k, lang] == pytest.approx(total(word, lang))


def test_expected_counts_cover_every_byte():
    piece, size = language.vocabulary(tokenizer_path("piece_bpe_32k.model"))
    weight = np.random.default_rng(2).random((len(piece), 1))
    data = np.frombuffer(b"windmillhouse", np.uint8)
    found = language.expected_counts(piece, weight, data, np.array([0, 4]), np.array([4, 13]),
                                     np.array([0, 0]), np.array([2.0, 3.0]))
    assert (found[:, 0] * size).sum() == pytest.approx(2 * 5 + 3 * 10)  # a blank before each


def test_language(spark):
    speech = {"aa": "tala moki sura peno", "bb": "grint strumf klopst wrang"}
    rows = [(k, " ".join(speech[lang].split()[(k + j) % 4] for j in range(12)),
             lang if k % 7 else None) for k, lang in enumerate(["aa", "bb"] * 60)]
    rows += [(500, None, "aa"), (501, "123 --", "aa"), (502, "", "bb"), (503, "x" * 3000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r["doc_id"]: r for r in
             language.identify(docs, tokenizer_path("piece_bpe_32k.model")).collect()}
    assert all(found[k]["lang_pred"] == ["aa", "bb"][k % 2] for k in range(120))
    assert [found[k]["lang_pred"] for k in (500, 501, 502)] == ["und"] * 3
    assert all(0 <= r["score"] <= 1 for r in found.values())
    odd_rows = language.identify(odd.frame(spark), tokenizer_path("piece_bpe_32k.model"))
    assert odd_rows.count() == len(odd.rows())
    none = language.identify(odd.empty(spark), tokenizer_path("piece_bpe_32k.model"))
    assert none.count() == 0


def test_secret_scan(spark):
    texts = []
    for k in range(120):
        key = "".join("0123456789abcdef"[(k * 7 + j * j * 3 + j) % 16] for j in range(24))
        texts.append(f"{odd.prose(k, 10)} password={key} {odd.prose(k + 1, 5)} kilometrestabletennis "
                     f"{'41' * 9} AKIA{key[:16].upper()} é {key[::-1]}")
    docs = odd.plain(spark, texts + [None, "", "short"])
    found = secrets.scan(docs, tokenizer_path()).collect()
    by = defaultdict(list)
    for r in found:
        own = texts[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        by["AKIA" if own.startswith("AKIA") else "digits" if own.isdigit() else
           "word" if own == "kilometrestabletennis" else "key" if len(own) == 24 else "other"].append(r["secret"])
    assert np.mean(by["AKIA"]) > 0.95 and not any(by["word"]) and not any(by["digits"])
    assert len(by["word"]) == 120
    assert secrets.scan(odd.empty(spark), tokenizer_path()).count() == 0
    assert secrets.scan(odd.frame(spark), tokenizer_path()).count() >= 1


def test_forest_learns_rare_secrets_of_a_large_table(spark):
    few, many = 20, 30_000
    size = len(secrets.FEATURES)
    labelled = spark.range(few + many).selectExpr(
        "id as doc_id", "0L as start", "20L as length", "id as text_crc32",
        f"cast(id < {few} as int) as label",
        f"transform(sequence(1, {size}), k -> if(id < {few}, 5D, 1D) + (id * k) % 7 / 10D) as features")
    rated = secrets.forest(labelled, rows=50)(labelled)
    found = rated.filter("probability >= 0.5").select("label").collect()
    assert [r["label"] for r in found] == [1] * few


def test_values_behind_a_name_are_candidates(spark):
    texts = {"é password=hunter2prod now": "hunter2prod", 'pwd: "a.b!c@d#e$f~g", x': "a.b!c@d#e$f~g",
             "token=abcdefghijklmnopqrst.uvw!9 z": "abcdefghijklmnopqrst.uvw!9", "secret = ü7 end": "ü7",
             "api_key='k1'": "k1", "auth=x": "x", '"passwd=q1w2"': "q1w2", "secret:" + " " * 90 + "z9": "z9"}
    docs = odd.plain(spark, [*texts, "password=", 'password=""', "author: hunter2prod", None])
    found = secrets.candidates(docs, tokenizer_path()).collect()
    every = list(texts)
    got = {(r["doc_id"], every[r["doc_id"]][r["start"]:r["start"] + r["length"]]) for r in found}
    assert got == set(enumerate(texts.values())) and len(found) == len(texts)
    label = {texts[every[r["doc_id"]]]: r["label"] for r in found}
    assert label["hunter2prod"] == 1 and label["x"] is None and label["z9"] == 1
    both = secrets.candidates(odd.plain(spark, ["token=password=abc1"]), tokenizer_path()).collect()
    assert sorted((r["start"], r["length"]) for r in both) == [(6, 13), (15, 4)]
