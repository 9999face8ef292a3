"""Links that nearer pairs, which aren't confirmed, would hide."""

import numpy as np

from strandmark.llm import simhash


def test_a_nearer_pair_hides_no_other(spark):
    """a and b are nearest, b and c next, a and c furthest, all within reach: every one of the three is a candidate of the second round."""
    shape = simhash.Shape.of(3, 0.8)
    rng = np.random.default_rng(7)
    a = rng.integers(0, 2, shape.bits)
    b, c = a.copy(), a.copy()
    b[20:30] ^= 1
    c[25:50] ^= 1
    rows = [(k, k, np.packbits(fp, bitorder="little").tobytes()) for k, fp in enumerate((a, b, c))]
    nodes = spark.createDataFrame(rows, "node long, label long, fp binary")
    found = simhash.near_candidates(nodes, shape, range(shape.segments), whole=True).collect()
    assert {(r.a, r.b) for r in found} == {(1, 0), (2, 0), (2, 1)}


def test_all_pairs_of_addresses():
    rng = np.random.default_rng(8)
    shape = simhash.Shape.of(3, 0.8)
    words = rng.integers(0, 1 << 63, (1, 4)).astype(np.uint64) ^ (np.uint64(1) << rng.integers(0, 63, (1500, 4)).astype(np.uint64))
    ids, labels = rng.permutation(1500), rng.integers(0, 700, 1500)
    address = np.repeat(np.arange(3, dtype=np.uint64), [1200, 299, 1])
    want = {(max(ids[i], ids[j]), min(ids[i], ids[j])) for i in range(1500) for j in range(i) if address[i] == address[j] and labels[i] != labels[j]}
    got = simhash._named(address, np.arange(1500), ids, labels, words, shape, True)
    assert len(got) == len(want) and set(map(tuple, got.tolist())) == want
