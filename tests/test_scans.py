"""Running values over ranges: equal to plain walks on a group that lies over many ranges."""

import random

import pytest
from pyspark.sql import functions as F

from strandmark.functions.statistics import benjamini_hochberg
from strandmark.operators import double_strand, intervals, scans


@pytest.fixture(autouse=True)
def ten_ranges(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "10")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_before_against_a_walk(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "a", "a", "b"]), k, rng.randint(-9, 9) if rng.random() < 0.9 else None) for k in rng.sample(range(1000), 400)] + [("c", 5, None)]
    rows = list({(g, k): (g, k, v) for g, k, v in rows}.values())
    parted = scans.ranged(spark.createDataFrame(rows, "g string, k long, v long"), ["g"], ["k"])
    assert parted.where("g = 'a'").select("_part").distinct().count() >= 7
    assert parted.groupBy("g", "_part").count().agg(F.max("count")).first()[0] < len(rows) / 4
    kinds = {"high": ("max", "v"), "low": ("min", "v"), "total": ("sum", "v"), "prior": ("last", "k")}
    for backward in (False, True):
        got = {(r.g, r.k): (r.high, r.low, r.total, r.prior) for r in scans.before(parted, ["g"], ["k"], kinds, backward).collect()}
        for g, k, _ in rows:
            some = sorted((r for r in rows if r[0] == g and (r[1] > k if backward else r[1] < k)), key=lambda r: r[1], reverse=backward)
            values = [r[2] for r in some if r[2] is not None]
            assert got[g, k] == (max(values, default=None), min(values, default=None), sum(values), some[-1][1] if some else None)


def spans(rng, n, reach):
    return [("chr1" if rng.random() < 0.9 else "chr2", a, a + rng.randint(1, reach)) for a in (rng.randrange(0, 3000) for _ in range(n))]


def test_merge_over_ranges(spark):
    rng = random.Random(2)
    for rows in (spans(rng, 300, 6), spans(rng, 300, 40), [("chr1", 0, 10_000), *spans(rng, 200, 3)], [("chr1", k, k + 1) for k in range(200)] * 2):
        want = []
        for c, a, b in sorted(rows):
            if want and want[-1][0] == c and a <= want[-1][2]:
                want[-1] = (c, want[-1][1], max(b, want[-1][2]))
            else:
                want.append((c, a, b))
        got = intervals.merge(spark.createDataFrame(rows, "contig string, start long, `end` long"))
        assert sorted(map(tuple, got.select("contig", "start", "end").collect())) == want
    assert intervals.merge(spark.createDataFrame([], "contig string, start long, `end` long")).count() == 0


def test_gaps_over_ranges(spark):
    rng = random.Random(3)
    cuts = sorted({0, 5000, *(rng.randrange(1, 5000) for _ in range(150))})
    rows = [("chr1", a, b) for a, b in zip(cuts, cuts[1:]) if rng.random() < 0.95] + [("chr1", 100, 140), ("chr1", 100, 140), ("chr2", 0, 10)]
    want, before = [], 0
    for _, a, b in sorted(r for r in rows if r[0] == "chr1"):
        if a != before:
            want.append(("chr1", before, "gap" if a > before else "overlap"))
        before = b
    last = max(b for c, _, b in rows if c == "chr1")
    want += [("chr1", last, "end")] * (last != 5000) + [("chr2", 10, "end"), ("chr3", 0, "end")]
    contigs = spark.createDataFrame([("chr1", 5000), ("chr2", 20), ("chr3", 7)], "contig string, length long")
    got = intervals.coverage_faults(spark.createDataFrame(rows, "contig string, start long, `end` long"), contigs)
    assert sorted(map(tuple, got.select("contig", "at", "fault").collect())) == sorted(want)


def test_components_over_ranges(spark):
    rng = random.Random(4)
    pairs = {("chr1", f, f + rng.randint(-2, 2)) for f in rng.sample(range(10, 900), 300)} | {("chr1", 2000 + 2 * k, 2000 + 2 * k + d) for k in range(60) for d in (-2, 0, 2)}
    got = double_strand.components(spark.createDataFrame(sorted(pairs), "contig string, forward_position long, reverse_position long"), 0).collect()
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for _, f, r in pairs:
        parent[root(("f", f))] = root(("r", r))
    together = {}
    for r in got:
        together.setdefault(r.component, set()).add(root(("f", r.forward_position)))
    # spans that overlap are one component; those of one graph component never lie in two
    assert len({x for s in together.values() for x in s}) == sum(map(len, together.values()))
    assert sorted(together) == list(range(1, len(together) + 1))
    assert len({r.component for r in got if r.forward_position >= 2000}) == 1


def test_q_values_over_ranges(spark):
    rng = random.Random(5)
    rows = [(k, rng.choice(["s", "s", "s", "t"]), rng.choice([None, rng.random(), rng.randrange(50) / 50, 0.0, 1.0])) for k in range(700)]
    for by in (["g"], []):
        got = {r.k: r.q for r in benjamini_hochberg(spark.createDataFrame(rows, "k long, g string, p double"), "p", "q", by, ["k"]).collect()}
        for g in ("s", "t") if by else (None,):
            own = sorted((p, k) for k, h, p in rows if p is not None and g in (h, None))
            least, want = 1.0, {}
            for rank in range(len(own), 0, -1):
                least = min(least, own[rank - 1][0] * len(own) / rank)
                want[own[rank - 1][1]] = least
            assert all(got[k] == pytest.approx(q, abs=1e-15) for k, q in want.items())
        assert all((got[k] is None) == (p is None) for k, _, p in rows)
