"""Analyses of the same inputs look at reads once for all of them, and find what each by itself finds."""

import random

import pytest
from pyspark.sql import functions as F
from util import covering, forward, frame, read, reverse, reverse_covering

from jobs import cleavage_calls
from strandmark import session
from strandmark.operators import double_strand, evidence, intervals, single_strand, sites
from strandmark.plans import calling
from strandmark.schema import Params

THRESHOLDS = {"ndigenome_min_count": 4, "digenome_forward_cutoff": 2, "digenome_reverse_cutoff": 2, "digenome_depth_cutoff": 4}


def tables(spark, folder):
    rows = forward(8, 500) + reverse(8, 500) + covering(5, 500) + reverse_covering(5, 500) + forward(9, 900) + covering(6, 900) + forward(3, 1500, cigar="20M2I28M") + reverse(5, 1501)
    frame(spark, rows).write.parquet(f"{folder}/reads")
    frame(spark, covering(9, 500) + reverse_covering(9, 500) + covering(9, 900) + forward(2, 500)).write.parquet(f"{folder}/control")
    spark.createDataFrame([("chr1", 5000)], "contig string, length long").write.parquet(f"{folder}/contigs")
    spark.createDataFrame([("chr1", 498, 499), ("chr1", 1400, 1450)], "contig string, start long, `end` long").write.parquet(f"{folder}/mask")
    return str(folder)


def test_a_job_of_two_analyses_looks_at_reads_as_one_does(spark, tmp_path, monkeypatch):
    where, out = tables(spark, tmp_path / "t"), str(tmp_path / "out")
    seen = []

    def spy(df, name):
        plan = df._jdf.queryExecution().executedPlan().toString()
        seen.extend((name, kind) for kind in ("reads", "control") if f"{where}/{kind}" in plan)
        return session.written(df, name)

    for module in (sites, single_strand, double_strand, evidence, calling, cleavage_calls):
        monkeypatch.setattr(module, "written", spy, raising=False)
    config = {"sample": "s", "control_sample": "c", "analyses": ["ndigenome", "digenome"], "check_inputs": False, "thresholds": THRESHOLDS}
    wrote = cleavage_calls.run(spark, where, out, config)
    assert [kind for _, kind in seen] == ["reads", "reads", "control"], seen
    # each analysis by itself leaves the same rows
    for analysis in config["analyses"]:
        assert cleavage_calls.run(spark, where, f"{out}-{analysis}", config | {"analyses": [analysis]}) == {analysis: wrote[analysis]}
        own, both = ((cleavage_calls.calls(spark, o).where(F.col("analysis") == analysis)) for o in (f"{out}-{analysis}", out))
        assert sorted(map(str, own.select(*sorted(own.columns)).collect())) == sorted(map(str, both.select(*sorted(own.columns)).collect())) and own.count() > 0


@pytest.mark.parametrize("overhang", [0, -30, 4])
def test_counts_around_an_anchor(spark, overhang):
    rng = random.Random(overhang)
    rows = [read(rng.choice([1000, 1024, 2040]) + rng.randint(-40, 40), flag=rng.choice([0, 16, 1024, 2048]), cigar=rng.choice(["50M", "7M", "1100M"]), mapq=rng.choice([0, 60])) for _ in range(150)]
    reads = frame(spark, rows)
    anchors = spark.createDataFrame([("chr1", p) for p in (0, 990, 1000, 1020, 1023, 1024, 1030, 2047, 2050)], "contig string, pos long")
    offsets = double_strand.grid_offsets(overhang)
    near = sites.cut(reads, anchors, double_strand.grid_reach(overhang))
    want = {}
    for (p,) in anchors.select("pos").collect():
        counts = []
        for o in offsets:
            cover = [r for r in rows if r[3] <= p + o < r[4] and not r[1] & 1796 and r[5] >= 1]
            counts += [sum(not r[1] & 16 and r[3] == p + o for r in cover), sum(bool(r[1] & 16) and r[4] - 1 == p + o for r in cover), len(cover)]
        want[p] = counts
    for some in (reads, near):
        got = {r["pos"]: list(r)[2:] for r in sites.around(anchors, some, offsets, 1).collect()}
        assert {p: got.get(p, [0] * len(c)) for p, c in want.items()} == want
    hidden = [(995, 1001), (1023, 1025), (2049, 2050), (0, 1), (960, 200_000_000)][: 4 + (overhang == 4)]
    mask = spark.createDataFrame([("chr1", a, b) for a, b in hidden], "contig string, start long, `end` long")
    bits = {p: sum(1 << k for k, o in enumerate(offsets) if any(a <= p + o < b for a, b in hidden)) for p in want}
    found = {r["pos"]: r["b"] for r in intervals.covered(anchors, mask, offsets, "b").collect()}
    assert {p: found.get(p, 0) for p in bits} == bits
