"""Long intervals and large files: few rows an interval, blocks of a file."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from strandmark.operators import intervals
from strandmark.sources import formats


def test_a_long_interval_is_few_rows(spark):
    df = spark.createDataFrame([("chr1", 1000, 200_001_000), ("chr2", 5, 9000), ("chr3", 7, 7)], "contig string, start long, end long")
    rows = intervals.at_home(df, F.col("start"), F.col("end")).groupBy("contig").count().collect()
    assert {r["contig"] for r in rows} == {"chr1", "chr2"} and max(r["count"] for r in rows) < 20


@pytest.fixture
def mixed():
    rng = random.Random(6)
    spans = []
    for _ in range(60):
        start = rng.randrange(0, 3_000_000)
        spans.append((rng.choice(["a", "b"]), start, start + int(10 ** rng.uniform(0, 7.8))))
    edges = [(c, x) for c, a, b in spans for x in (a - 1, a, b - 1, b) if x >= 0]
    return spans, edges + [(rng.choice(["a", "b", "c"]), rng.randrange(0, 60_000_000)) for _ in range(200)]


def test_points_in_intervals_of_all_lengths(spark, mixed):
    spans, points = mixed
    points = [*points, points[0], ("a", None)]
    i = spark.createDataFrame([(*s, k) for k, s in enumerate(spans)], "contig string, start long, end long, k long")
    p = spark.createDataFrame([(*x, n) for n, x in enumerate(points)], "contig string, pos long, n long")
    want = {(n, k) for n, (c, x) in enumerate(points) for k, (d, a, b) in enumerate(spans) if x is not None and c == d and a <= x < b}
    got = [(r.n, r.k) for r in intervals.at_positions(p, i).collect()]
    assert set(got) == want and len(got) == len(want)
    inside = {n for n, _ in want}
    for how, expected in (("left_semi", inside), ("left_anti", set(range(len(points))) - inside)):
        out = intervals.at_positions(p, i, "pos", how)
        assert out.columns == p.columns and sorted(r.n for r in out.collect()) == sorted(expected)


def test_subtraction_across_levels(spark, mixed):
    spans, _ = mixed
    rng = random.Random(7)
    own = [(c, a, a + int(10 ** rng.uniform(0, 7.8))) for c, a, _ in spans[:25]]
    schema = "contig string, start long, end long"
    merged = intervals.merge(spark.createDataFrame([s for s in spans[25:] if s[2] - s[1] < 200_000], schema))
    mask = [tuple(r) for r in merged.select("contig", "start", "end").collect()]
    want = set()
    for c, a, b in own:
        at = a
        for _, s, e in sorted(m for m in mask if m[0] == c and m[1] < b and m[2] > a):
            want |= {(c, a, b, at, s)} if s > at else set()
            at = max(at, e)
        want |= {(c, a, b, at, b)} if at < b else set()
    got = [(r.contig, r.own_start, r.own_end, r.start, r.end) for r in intervals.subtract(spark.createDataFrame(own, schema), merged).collect()]
    assert set(got) == want and len(got) == len(want)


def test_digests_by_blocks(spark, tmp_path):
    paths, want = [], []
    for k, size in enumerate((0, 1, 4096, 10_001)):
        data = random.Random(k).randbytes(size)
        path = tmp_path / f"{k}.fa"
        path.write_bytes(data)
        paths.append(str(path) if k % 2 else f"file://{path}")
        want.append((paths[-1], size, hashlib.sha256(data).hexdigest()))
    assert sorted(map(tuple, formats.digests(spark, paths, 4096).collect())) == sorted(want)
    assert formats.sha256(spark, paths[3]) == want[3][2]
