import numpy as np
import pytest

from millrace.llm import language, secrets_forest
from millrace.llm.tokens import tokenizer_path


def vocabulary(words):
    raw = sorted({bytes([b]) for b in range(256)} | {w.encode() for w in words})
    code = np.array([language._range_hash(language._prefix(np.frombuffer(p, np.uint8)),
                                          np.array([0]), np.array([len(p)]))[0] for p in raw])
    order = np.argsort(code)
    return code[order], {p: int(np.flatnonzero(order == k)[0]) for k, p in enumerate(raw)}


def segmentations(word, known):
    if not word:
        yield []
    for size in range(1, len(word) + 1):
        if word[:size] in known:
            for rest in segmentations(word[size:], known):
                yield [known[word[:size]], *rest]


def test_all_segmentations_are_summed_and_expected():
    piece, known = vocabulary(["ab", "abc", " a", "bc", "ca", "cab", "b ", "aa", "aaa", "é"])
    rng = np.random.default_rng(3)
    weight = rng.random((len(piece), 2)) + 0.05
    model = language.Model(["x", "y"], piece, weight)
    texts = ["abcab", "aaaa", "c", "éab", "abcabcab"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    size = [len(t.encode()) for t in texts]
    end = np.cumsum(size)
    start = end - size
    lang, count = np.array([0, 1, 0, 1, 1]), np.array([2.0, 1.0, 3.0, 1.0, 5.0])
    want = np.zeros(weight.shape)
    for k, text in enumerate(texts):
        cuts = list(segmentations(b" " + text.encode(), known))
        chance = [np.prod(weight[c], axis=0) for c in cuts]
        whole = np.sum(chance, axis=0)
        scale = (size[k] + 1) * np.log(language.SCALE)
        got = language.word_scores(model, data, start[k:k + 1], end[k:k + 1])[0]
        assert got == pytest.approx(np.log(whole) - scale)
        word = language.Long(piece, np.frombuffer(b" " + text.encode(), np.uint8))
        assert word.score(weight) == pytest.approx(np.log(whole))
        for cut, p in zip(cuts, chance):
            for place in cut:
                want[place, lang[k]] += count[k] * p[lang[k]] / whole[lang[k]]
    assert language.expected_counts(piece, weight, data, start, end, lang, count) == pytest.approx(want)
    one_by_one = np.zeros(weight.shape)
    for k, text in enumerate(texts):
        word = language.Long(piece, np.frombuffer(b" " + text.encode(), np.uint8))
        word.add_expected(one_by_one, lang[k], weight, count[k])
    assert one_by_one == pytest.approx(want)


def test_long_words_are_not_cut(monkeypatch):
    piece, size = language.vocabulary(tokenizer_path("piece_bpe_32k.model"))
    weight = np.random.default_rng(2).random((len(piece), 2)) * language.SCALE ** size[:, None] * 1e-3
    model = language.Model(["x", "y"], piece, weight)
    text = ("windmillhouseünder" * 40).encode()
    data = np.frombuffer(text, np.uint8)
    at = np.array([0]), np.array([len(text)])
    whole = language.word_scores(model, data, *at)
    monkeypatch.setattr(language, "TOGETHER", 1 << 20)
    short = np.array([0]), np.array([400])
    together = language.word_scores(model, data, *short)
    monkeypatch.setattr(language, "TOGETHER", 4)
    assert language.word_scores(model, data, *short) == pytest.approx(together)
    assert np.isfinite(whole).all() and (whole < together).all()


def test_training_spells_words_as_scoring_does(spark):
    docs = spark.createDataFrame([(k, "ÉTÉ Яблоко House", "x") for k in range(8)], "doc_id long, text string, lang string")
    assert {r["word"] for r in language.training_words(docs).collect()} == {"ÉtÉ", "Яблоко", "house"}


def test_names_without_values_take_linear_time():
    import time
    raw = b"token" + b" " * 3_000_000 + b"x auth'" + b" " * 3_000_000 + b"password = hunter2"
    began = time.perf_counter()
    found = secrets_forest.named_values(raw, 0, len(raw))
    assert time.perf_counter() - began < 2
    assert [raw[a:b] for a, (b, _) in found.items()] == [b"hunter2"]
