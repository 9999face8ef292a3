"""One-bit codes: bounds hold, few rows survive, repeated rows count, and recall over clustered and even vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandmark.llm import neighbours


def made(kind, n=4000, dim=48):
    rng = np.random.default_rng(5)
    if kind == "even":
        return rng.standard_normal((n, dim))
    return 4 * rng.standard_normal((40, dim))[rng.integers(0, 40, n)] + rng.standard_normal((n, dim))


def test_bounds_hold_and_are_near():
    x = made("even")
    turn, centre = neighbours.rotation(48), x.mean(axis=0)
    words, size, f = neighbours.encode(x[100:], centre, turn)
    low, high = neighbours.bounds((x[:100] - centre) @ turn, words, size, f)
    real = ((x[:100, None] - x[None, 100:]) ** 2).sum(axis=2)
    assert ((low <= real) & (real <= high)).mean() > 0.985
    assert abs(((low + high) / 2 - real).mean()) < 0.02 * real.mean() and np.corrcoef(((low + high) / 2).ravel(), real.ravel())[0, 1] > 0.8


def test_inner_products_come_from_counted_bits():
    rng = np.random.default_rng(1)
    x, q = rng.standard_normal((50, 130)), rng.standard_normal((7, 130))
    turn = neighbours.rotation(130)
    words, size, f = neighbours.encode(x, np.zeros(130), turn)
    assert words.shape == (50, 3) and words.dtype == np.uint64
    signs = np.where(x / np.linalg.norm(x, axis=1)[:, None] @ turn > 0, 1, -1) / np.sqrt(130)
    low, high = neighbours.bounds(q @ turn, words, size, f)
    want = (q * q).sum(1)[:, None] + (x * x).sum(1)[None] - 2 * (q @ turn @ signs.T) * (size / f)[None]
    assert np.abs((low + high) / 2 - want).max() < 0.2 * np.abs(want).max()


@pytest.mark.parametrize("kind", ["even", "clustered"])
def test_recall_and_survivors(spark, kind, monkeypatch):
    x = made(kind)
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(5)
    got = {}
    for r in neighbours.nearest(rows, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, len(x), 100):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hits += len(got[q] & set(np.argsort(d)[:10].tolist()))
    assert hits >= 0.98 * 10 * len(got) and len(got) == 40


def test_few_vectors_are_measured(monkeypatch):
    x = made("clustered")
    turn = neighbours.rotation(48)
    centres = neighbours.centroids(x)
    near = neighbours.nearest_centroid(x, centres)
    blocks = [(c, np.flatnonzero(near == c), x[near == c], *neighbours.encode(x[near == c], centres[c], turn)) for c in np.unique(near)]
    compared, measured = [], []
    bounds, add = neighbours.bounds, neighbours.Best.add
    monkeypatch.setattr(neighbours, "bounds", lambda q, w, *a: (compared.append(len(q) * len(w)), bounds(q, w, *a))[1])
    monkeypatch.setattr(neighbours.Best, "add", lambda self, q, v, d: (measured.append(len(q)), add(self, q, v, d))[1])
    ids, found, score = neighbours.search_cell(np.arange(0, 4000, 100), x[::100], x[::100] @ turn, blocks, centres @ turn, 10)
    assert sum(compared) < 0.6 * 40 * 4000 and sum(measured) < 0.25 * 40 * 4000 and len(ids) == 400
    assert np.allclose(score, np.sqrt(((x[ids] - x[found]) ** 2).sum(axis=1)))


def test_repeated_rows_and_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [3.0, 0.0]), (2, [1.0, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [float("inf"), 1.0]), (7, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (0, [9.0, 9.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(vectors, F.col("vec_id") == 0, 4).collect()
    assert [(r.rank, r.vec_id, round(r.score, 6)) for r in sorted(got, key=lambda r: r.rank)] == [(1, 2, 0.5), (2, 1, 1.0), (3, 1, 1.0), (4, 2, 2.0)]
    assert neighbours.nearest(vectors.where("vec_id > 2"), F.lit(True)).count() in (0,)
