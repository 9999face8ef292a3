"""SimHash tables by segments: hot segment values, crowded addresses, and how the work grows."""

import random

import numpy as np

from strandmark.llm import simhash


def brute_links(marks):
    return {(a, b) for a in marks for b in marks if a > b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}


def test_links_are_all_pairs_whether_segments_are_hot_or_not(spark):
    rng = random.Random(2)
    marks = {rng.getrandbits(63) for _ in range(40)}
    marks |= {m ^ 1 << rng.randrange(63) for m in list(marks)}
    low = rng.getrandbits(32)  # one segment value that very many share
    dense = rng.getrandbits(31)
    marks |= {(dense ^ sum(1 << rng.randrange(31) for _ in range(rng.randrange(3)))) << 32 | low for _ in range(200)}
    marks |= {m ^ 1 << rng.randrange(32) for m in list(marks)[:100]}
    fps = spark.createDataFrame([(m,) for m in marks], "fp long")
    want = brute_links(marks)
    assert len(want) > 300
    for hot in (10**6, 20, 0):
        got = simhash.links(fps, hot).collect()
        assert {(r.a, r.b) for r in got} == want and len(got) == len(want)


def test_addresses_over_word_bounds():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 63, (5, 4)).astype(np.uint64)
    whole = [sum(int(w) << 64 * k for k, w in enumerate(row)) for row in words]
    got = simhash._addresses(words, 19, range(2, 11))
    for k, n in enumerate(whole):
        want = [(s << 19) | (n >> 19 * s & (1 << 19) - 1) ^ f for s in range(2, 11) for f in (0, *(1 << b for b in range(19)))]
        assert got[k].tolist() == want


def test_work_a_document_hardly_grows():
    def compared(n):
        s = simhash.Shape.of(n, 0.8)
        return s.segments * (s.width + 1) ** 2 * n / 2**s.width

    # a document's comparisons grow by less than the number of documents to the power 0.4
    assert all(compared(4 * n) / compared(n) < 4**0.4 for n in (2**18, 2**20, 2**24, 2**28, 2**30))
    assert simhash.Shape.of(10, 0.8).segments * simhash.Shape.of(10, 0.8).width <= simhash.Shape.of(10, 0.8).bits


def test_crowded_addresses_lose_no_group(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    texts = {}
    for k in range(120):
        words = list(base)
        for _ in range(rng.randrange(3)):
            words[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        texts[k] = " ".join(words)
    other = [f"v{rng.randrange(10**6)}" for _ in range(200)]
    texts |= {500 + k: " ".join([*other[:199], f"y{k}"]) for k in range(30)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    monkeypatch.setattr(simhash, "CROWD", 25)
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == [0, 500]
