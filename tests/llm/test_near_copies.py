"""Near copies of isolated pairs: the shingle sets decide, not the fingerprints."""

import random

import pytest

from strandmark.llm import simhash


def pair(rng, shared, own):
    """Two texts with ``shared`` shingles in common and ``own`` more each: one word of the ending differs a shingle."""
    words = [f"w{rng.randrange(10**9)}" for _ in range(shared + 4)]
    ends = [[f"x{rng.randrange(10**9)}" for _ in range(own)] for _ in range(2)]
    return tuple(" ".join(words + e) for e in ends)


def brute(a, b, width=5):
    sets = [{tuple(w[k : k + width]) for k in range(len(w) - width + 1)} for w in (a.split(), b.split())]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(4)
    return {own: [pair(rng, 200, own) for _ in range(150)] for own in (24, 26, 40)}


def test_isolated_pairs_are_decided_by_the_shingles(spark, pairs):
    rows, want, n = [], set(), 0
    for made in pairs.values():
        for a, b in made:
            rows += [(2 * n, a), (2 * n + 1, b)]
            want |= {2 * n + 1} if brute(a, b) >= 0.8 else set()
            n += 1
    # equal by majority, not as sets: a shingle repeated more often than all others
    rows += [(10_000, "again " * 400 + " ".join(f"p{k}" for k in range(60))), (10_001, "again " * 400 + " ".join(f"q{k}" for k in range(60)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    gone = {i for i, _ in rows} - {r.doc_id for r in simhash.keep_one(docs).select("doc_id").collect()}
    assert len(want) == 150 and not gone - want
    assert len(gone) >= 0.97 * len(want)


def test_rows_that_share_an_id_go_apart(spark):
    rng = random.Random(9)
    (a, near), (other, _) = pair(rng, 200, 5), pair(rng, 200, 5)
    docs = spark.createDataFrame([(1, a), (2, near), (2, other)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in simhash.keep_one(docs).collect()) == [(1, a), (2, other)]
