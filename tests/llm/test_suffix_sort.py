"""Suffix dedup: cuts rest on bytes whatever the hashes say; the sort and its boundaries."""

import random

import numpy as np
import pytest
from test_operators import brute_cut

from strandmark.llm import suffixes


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["ab", "the", "ou", "x" * 9, "é", "tion", "%%%"]
    some = lambda k: " ".join(rng.choice(words) + str(rng.randrange(30)) for _ in range(k))
    shared = [some(30) for _ in range(8)]
    texts = {}
    for k in range(n):
        texts[k] = "".join((some(rng.randrange(12)), rng.choice(shared)[rng.randrange(20) :], rng.choice(["", "ab" * rng.randrange(90), "-" * rng.randrange(70)]), some(rng.randrange(9))))
    texts |= {n + k: texts[k] for k in range(0, n, 7)}
    texts[2 * n + 1] = texts[3][: suffixes.LENGTH]
    texts[2 * n + 2] = texts[3][: suffixes.LENGTH - 1]
    return texts


@pytest.mark.parametrize("hash_bits", [64, 13, 8, 0])
def test_colliding_hashes_cut_nothing_else(spark, hash_bits):
    texts = corpus(hash_bits, 150)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.repeats(docs, hash_bits=hash_bits).collect()}
    assert got == brute_cut(texts, suffixes.LENGTH)


def test_rows_that_share_an_id_never_cut_each_other(spark):
    text = corpus(1, 3)[0] * 3
    docs = spark.createDataFrame([(5, text), (5, text), (9, text), (9, "")], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_removed) for r in suffixes.repeats(docs).collect())
    assert got == [(5, 0), (5, 0), (9, 0), (9, len(text.encode()))]


@pytest.mark.parametrize("n, width, letters", [(0, 3, 3), (1, 2, 2), (700, 5, 3), (900, 3, 1), (5000, 4, 1 << 60)])
def test_multikey_quicksort_and_shared_words(n, width, letters):
    rng = np.random.default_rng(n)
    words = rng.integers(0, letters, (n, width)).astype(np.uint64)
    words[n // 2 :] = words[: n - n // 2]
    order, shared = suffixes.multikey(words)
    rows = [tuple(r) for r in words[order].tolist()]
    assert rows == sorted(map(tuple, words.tolist()))
    for k in range(1, n):
        assert shared[k] == next((i for i, (a, b) in enumerate(zip(rows[k - 1], rows[k])) if a != b), width)


def test_a_string_across_a_boundary_is_noticed():
    bounds = np.array(sorted([b"b" * 50, b"m" * 50]), "S50")
    suffixes.across(bounds, 1, [b"b" * 20, b"c" * 20])
    with pytest.raises(ValueError):
        suffixes.across(bounds, 1, [b"c" * 20, b"m" * 20])
