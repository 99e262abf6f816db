import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from millrace.llm.text import chunks, ragged, shingles, sums, text_buffers, words
from millrace.llm.tokens import encoder, tokenizer_path

TEXT = st.text(alphabet=st.sampled_from("aBcé.,' \n\t\r\x0b<|>1漢\x1c"), max_size=60)


def pieces(texts):
    data, at = text_buffers(pa.array(texts, pa.string()))
    return data[at[0]:at[-1]], at - at[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_words_are_those_of_the_pattern(texts):
    data, at = pieces(texts)
    found = words(data, at)
    seen, raw = {}, data.tobytes()
    for r, text in enumerate(texts):
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text)
        want = re.findall(r"[^\x20\x09-\x0D]+", low)
        got = range(found.first[r], found.first[r + 1])
        assert len(want) == len(got)
        for w, k in zip(want, got):
            assert raw[found.start[k]:found.end[k]].decode().lower() == w.lower()
            assert seen.setdefault(w, found.hash[k]) == found.hash[k]
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcd"), max_size=9), min_size=1, max_size=5))
def test_shingles(rows):
    data, at = pieces([" ".join(r) for r in rows])
    code, own = shingles(words(data, at))
    seen = {}
    for r, row in enumerate(rows):
        want = [tuple(row[i:i + 5]) for i in range(len(row) - 4)] or ([tuple(row)] if row else [])
        got = code[own[r]:own[r + 1]]
        assert len(got) == len(want)
        for w, c in zip(want, got):
            assert seen.setdefault(w, c) == c
    assert len(set(map(int, seen.values()))) == len(seen)


@settings(max_examples=80, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5))
def test_tokens_are_those_of_the_whole_text(texts):
    own = encoder(tokenizer_path())
    ids, at = own.encode(*pieces(texts))
    for r, text in enumerate(texts):
        want = own.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids[at[r]:at[r + 1]].tolist() == want


def test_chunks_cover_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "", "b" * 50, "c"]})
    parts = list(chunks([batch, batch.slice(0, 0), batch.slice(2)], size=12))
    assert [p[0].num_rows for p in parts] == [3, 1, 1, 1, 1, 1]
    assert all(len(p[1]) == p[2][-1] for p in parts)
    assert ragged(np.array([5, 9]), np.array([2, 3])).tolist() == [5, 6, 9, 10, 11]
    assert sums(np.array([1, 2, 3]), np.array([0, 0, 2, 3])).tolist() == [0, 3, 3]
