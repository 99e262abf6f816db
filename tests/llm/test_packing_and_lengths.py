import zlib
from collections import Counter, defaultdict

import numpy as np
import odd
import pytest

from millrace.llm import packing, token_lengths as lengths
from millrace.llm.tokens import encoder, tokenizer_path


def ids_of(text):
    return encoder(tokenizer_path()).tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packed_pieces_are_whole_and_gapless(spark, capacity):
    docs = odd.frame(spark)
    found = packing.pack(docs, tokenizer_path(), capacity, grain=4).collect()
    want = Counter()
    for i, text, *_ in odd.rows():
        ids = np.array(ids_of(text) + [1], "<u4")
        for a in range(0, len(ids), capacity):
            part = ids[a:a + capacity]
            want[i, a // capacity, a, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in found) == want
    places = defaultdict(list)
    for r in found:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r["length"] for r in found)
    assert len(places) <= 1.2 * total / capacity + 1


def test_sequences_hold_the_ids(spark):
    docs = odd.plain(spark, [odd.prose(k, 30 * k + 1) for k in range(12)])
    packed = packing.pack(docs, tokenizer_path(), 256, grain=4)
    held = {r["sequence_id"]: r["ids"] for r in
            packing.sequences(docs, packed, tokenizer_path(), 256).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in packed.collect():
        ids = (ids_of(texts[r["doc_id"]]) + [1])[r["start"]:r["start"] + r["length"]]
        assert held[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == ids


def test_empty_tables(spark):
    assert packing.pack(odd.empty(spark), tokenizer_path()).count() == 0
    assert lengths.with_suffix_sums(lengths.histogram(odd.empty(spark), tokenizer_path())).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs_use_each_piece_once_and_come_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    count = np.zeros(513, np.int64)
    np.add.at(count, np.clip(rng.lognormal(4.2, 0.9, 4000).astype(int), 1, 512), 1)
    runs, bound = packing.runs_of(count, 512, grain=4, rounds=300)
    used = np.zeros_like(count)
    for pattern, times in runs:
        assert sum(v * n for v, n in pattern.items()) <= 512
        for v, n in pattern.items():
            used[v] += n * times
    assert (used == count).all()
    assert sum(times for _, times in runs) <= 1.02 * bound + 1
    more, _ = packing.runs_of(count * 10 ** 6, 512, grain=4, rounds=300)
    assert len(more) < 20 * len(count)


def test_knapsack_and_program_bound():
    sizes, prices = np.array([3, 4, 5]), np.array([3.0, 4.5, 5.2])
    best = packing.best_filling(sizes, prices, 9)
    assert sum(sizes[k] * n for k, n in best.items()) <= 9
    value = sum(prices[k] * n for k, n in best.items())
    assert value == max(3 * a + 4.5 * b + 5.2 * c for a in range(4) for b in range(3) for c in range(2)
                        if 3 * a + 4 * b + 5 * c <= 9)
    # Two thirds of the capacity each: one per sequence, which volume alone would not show.
    used, bound = packing.configurations(np.array([6]), np.array([10.0]), 9)
    assert bound == pytest.approx(10) and sum(used.values()) == pytest.approx(10)


def test_suffix_sums(spark):
    docs = odd.frame(spark)
    sums = lengths.with_suffix_sums(lengths.histogram(docs, tokenizer_path()), band=8)
    every = np.array([len(ids_of(t)) for _, t, *_ in odd.rows()])
    rows = sums.collect()
    assert sum(r["documents"] for r in rows) == len(every)
    for r in rows:
        v = r["length"]
        assert (r["documents"], r["longer"], r["up_to"]) == (
            (every == v).sum(), (every > v).sum(), (every <= v).sum())
        assert (r["tokens_longer"], r["truncated"]) == (
            every[every > v].sum(), np.minimum(every, v).sum())
    for r in lengths.at_limits(sums, [0, 1, 50, 10 ** 6]).collect():
        limit = r["context_limit"]
        assert (r["longer"], r["truncated"]) == ((every > limit).sum(), np.minimum(every, limit).sum())
    assert lengths.quantile(sums, 0.5) == np.sort(every)[int(np.ceil(0.5 * len(every))) - 1]
