"""Crowded addresses of near-dedup: pairs that share nothing else meet, in whichever tasks their members are dealt."""

import numpy as np
import pytest

from strandmark.llm import neighbours, simhash


def far_in_all_but_the_first(rng, fp, shape):
    """A fingerprint with the same first segment, three bits away in each other one."""
    out = fp.copy()
    for k in range(1, shape.segments):
        for bit in rng.choice(shape.width, 3, replace=False):
            out[k * shape.width + bit] ^= 1
    return out


@pytest.mark.parametrize("dominant", [0, 90])
def test_pairs_that_share_a_crowded_address_only(spark, monkeypatch, dominant):
    monkeypatch.setattr(simhash, "CROWD", 25)
    rng = np.random.default_rng(3)
    shape = simhash.Shape.of(300, 0.8)
    first = rng.integers(0, 2, shape.width)
    prints = []
    for _ in range(90 + dominant):
        fp = rng.integers(0, 2, shape.bits)
        fp[: shape.width] = first
        prints.append(fp)
    pairs = set()
    # others with others, and (where there are such) others with members of the frequent label
    for k in [*range(0, 60, 3), *range(90, 90 + dominant, 9)]:
        prints.append(far_in_all_but_the_first(rng, prints[k], shape))
        pairs.add((len(prints) - 1, k))
    prints += [rng.integers(0, 2, shape.bits) for _ in range(100)]
    label = lambda k: -5 if 90 <= k < 90 + dominant else k
    rows = [(k, label(k), np.packbits(fp, bitorder="little").tobytes()) for k, fp in enumerate(prints)]
    nodes = spark.createDataFrame(rows, "node long, label long, fp binary").repartition(4)
    found = set()
    parts = simhash._crowds(nodes, len(rows), shape, range(2))
    assert parts and all(a > 1 for a, _, _ in parts.values()) and (not dominant or any(m > 1 and label == -5 for _, m, label in parts.values()))
    for segments, again in ((range(2), range(0)), (range(2, shape.segments), range(2))):
        found |= {(r.a, r.b) for r in simhash.near_candidates(nodes, shape, segments, again).collect()}
    assert pairs <= found
    bits = lambda a, b: int((prints[a] != prints[b]).sum())
    assert all(bits(a, b) <= shape.most and label(a) != label(b) for a, b in found)


def test_no_crowd_no_sample(spark):
    nodes = spark.createDataFrame([(1, 1, bytes(32))], "node long, label long, fp binary")
    assert simhash._crowds(nodes, 1, simhash.Shape.of(1, 0.8), range(2)) == {}


def test_unusable_vectors_before_usable_ones(spark):
    rng = np.random.default_rng(2)
    good = rng.standard_normal((20, 8))
    bad = [None, [], [0.0] * 8, [None] * 8, [float("nan")] + [1.0] * 7, [float("inf")] * 8, [float("-inf")] + [0.0] * 7]
    rows = [(k, bad[k % len(bad)]) for k in range(1, 5001)] + [(100 * (5000 + k), v.tolist()) for k, v in enumerate(good)]
    # other lengths among themselves
    short = rng.standard_normal((6, 3))
    rows += [(100 * (9000 + k), v.tolist()) for k, v in enumerate(short)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = neighbours.nearest(df, (neighbours.F.col("vec_id") % 100) == 0, 10).collect()
    for base, x in ((5000, good), (9000, short)):
        for q in range(len(x)):
            d = np.sqrt(((x - x[q]) ** 2).sum(1))
            d[q] = np.inf
            want = [100 * (base + int(i)) for i in np.argsort(d)[: min(10, len(x) - 1)]]
            own = sorted((r for r in got if r.query_id == 100 * (base + q)), key=lambda r: r.rank)
            assert [r.vec_id for r in own] == want
    assert {r.query_id for r in got} == {r[0] for r in rows if r[0] >= 500000}
