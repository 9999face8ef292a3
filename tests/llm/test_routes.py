"""Where near-dedup sends fingerprints: all that share an address meet, whatever is cut, at a bounded size a document."""

import numpy as np
import pytest

from strandmark.llm import simhash


@pytest.mark.parametrize(("width", "total"), [(16, 300), (19, 2**21), (22, 2**24), (28, 2**30)])
def test_values_within_two_bits_agree_in_some_mask(width, total):
    masks = simhash.routes(total, 64, width)
    for a in range(width):
        for b in range(width):
            assert any(not m & (1 << a | 1 << b) for m in masks)
    assert total * 64 >> min(m.bit_count() for m in masks) <= simhash.PLACE_BYTES // 2


def test_bytes_a_document():
    text = 2200  # of a document of the test tables, on average
    for n in (10**5, 262_144, 300_000, 10**6, 14_000_000):
        assert simhash.bytes_a_document(n, 0.8) <= 2 * text
    assert simhash.bytes_a_document(10**9, 0.8) <= 12 * text


@pytest.mark.parametrize("place_bytes", [16 << 20, 3000])
def test_candidates_are_those_of_brute_force(spark, monkeypatch, place_bytes):
    monkeypatch.setattr(simhash, "PLACE_BYTES", place_bytes)
    rng = np.random.default_rng(8)
    shape = simhash.Shape.of(300, 0.8)
    prints = [rng.integers(0, 2, shape.bits) for _ in range(120)]
    # a third of all share a place: its bits and some others
    for _ in range(80):
        fp = rng.integers(0, 2, shape.bits)
        fp[:8] = 1
        prints.append(fp)
    for k in range(0, 200, 2):
        fp = prints[k].copy()
        fp[rng.choice(shape.bits, rng.integers(1, shape.most), replace=False)] ^= 1
        prints.append(fp)
    fps = np.array(prints)
    rows = [(k, k, np.packbits(fp, bitorder="little").tobytes()) for k, fp in enumerate(prints)]
    nodes = spark.createDataFrame(rows, "node long, label long, fp binary").repartition(3)
    heavy, pieces = simhash._heavy(nodes, len(rows), simhash.entry_bytes(shape, False), shape.width, range(2), simhash.routes(len(rows), 50, shape.width))
    assert bool(len(heavy)) == (place_bytes == 3000) and (pieces > 1).all()
    for segments in (range(2), range(2, shape.segments)):
        found = {(r.a, r.b) for r in simhash.near_candidates(nodes, shape, segments).collect()}
        near = set()
        for a in range(1, len(fps)):
            apart = fps[a] != fps[:a]
            own = apart[:, segments.start * shape.width : segments.stop * shape.width].reshape(a, -1, shape.width).sum(2)
            near |= {(a, int(b)) for b in np.flatnonzero((own.min(1) <= 2) & (apart.sum(1) <= shape.most))}
        # what brute force names is connected by what is found, and nothing else is
        root = list(range(len(fps)))

        def top(k, root=root):
            while root[k] != k:
                k = root[k]
            return k

        for a, b in found:
            root[top(a)] = top(b)
        assert found <= near and near and all(top(a) == top(b) for a, b in near)
