"""Reads cut to places: the same evidence as from all reads, by one pass that exchanges no read."""

import random

from pyspark.sql import functions as F
from util import frame, read

from strandmark.operators import double_strand, intervals, single_strand, sites
from strandmark.plans import calling
from strandmark.plans.calling import Inputs
from strandmark.schema import Params

CIGARS = ["50M", "50M", "50M", "5S45M", "45M5S", "20M2I28M", "20M3D27M", "3H47M", "10M5N35M", "1100M", "24M1I1D25M", "25=1X24=", "10M2P40M", "50I"]


def rows_of(df):
    return sorted(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())


def scene(rng, n=900):
    rows = []
    for k in range(n):
        at = rng.choice([1000, 1024, 2047, 2050, 3000, 10_000, 4096 * 1024 - 20, 4096 * 1024 + 3]) + rng.randint(-15, 15)
        flag = rng.choice([0, 16]) | rng.choice([0, 0, 0, 4, 256, 512, 1024, 2048, 1])
        rows.append(read(at - (49 if flag & 16 else 0), flag=flag, cigar=rng.choice(CIGARS), mapq=rng.choice([0, 3, 60]), nm=rng.choice([None, 0, 2]), contig=rng.choice(["chr1", "chr2"]), name=f"q{rng.randint(0, n)}"))
    return rows


def test_evidence_is_that_of_all_reads(spark):
    rng = random.Random(2)
    reads = frame(spark, scene(rng))
    piles = sites.pileups(reads, 2, 1)
    some = piles.where("pos % 3 < 2 AND pos <> 1024")
    near = sites.cut(reads, some, 10)
    assert {"_bin", "cigar"} <= set(near.columns) and near.where("contig NOT IN ('chr1', 'chr2')").isEmpty()
    assert near.where(F.col("cigar").isNotNull() & ~F.col("cigar").rlike("[IDSH]")).isEmpty() and near.where(F.col("query_name").isNotNull() & F.col("cigar").isNull()).isEmpty()
    for window in (0, 4, 10):
        assert rows_of(sites.metrics(some, near, window, 1)) == rows_of(sites.metrics(some, reads, window, 1))
    assert rows_of(sites.depths(some, near, 1)) == rows_of(sites.depths(some, reads, 1))
    assert rows_of(sites.single_base(some, near, 1)) == rows_of(sites.single_base(some, reads, 1))
    own = some.select("contig", "pos", "strand")
    assert rows_of(sites.endpoints(near, 1, own)) == rows_of(sites.endpoints(reads, 1, own))
    assert some.count() > 15
    assert sites.cut(near, some, 10) is near


def test_a_bin_has_one_bit(spark):
    places = spark.createDataFrame([("c", p) for p in (0, 5, 1023, 1024, 64 * 1024, 4096 * 1024 - 1, 4096 * 1024, 300_000_000, -3)], "contig string, pos long")
    rows = {r._block: {64 * w + b for w, bits in r.words.items() for b in range(64) if bits >> b & 1} for r in sites.bin_map(places).collect()}
    assert rows == {0: {0, 1, 64, 4095}, 1: {0}, 300_000_000 // 1024 // 4096: {300_000_000 // 1024 % 4096}}
    # however many places, a row for four million bases
    assert sites.bin_map(spark.range(0, 9_000_000, 7).select(F.lit("c").alias("contig"), F.col("id").alias("pos"))).count() == 3


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reads_are_cut_once_without_an_exchange(spark, monkeypatch, tmp_path):
    """A call looks at all reads twice, for the pile-ups and for the cut; both come from plans without an exchange of reads."""
    rng = random.Random(5)
    frame(spark, scene(rng)).write.parquet(str(tmp_path / "reads"))
    reads = spark.read.parquet(str(tmp_path / "reads"))
    seen, cuts = [], []
    from strandmark import session

    def spy(df, name):
        plan = plan_of(df)
        # what has been cut already reads folders of the session, not the reads'
        if str(tmp_path / "reads") in plan:
            seen.append(name)
            if name == "cut-reads":
                cuts.append(plan)
        return session.written(df, name)

    for module in (sites, single_strand, double_strand):
        monkeypatch.setattr(module, "written", spy)
    contigs = spark.createDataFrame([("chr1", 5_000_000), ("chr2", 5_000_000)], "contig string, length long")
    for params, piles in ((Params(analysis="ndigenome", ndigenome_min_count=3, ndigenome_min_fraction=0.05), "scanned"), (Params(analysis="digenome", digenome_forward_cutoff=1, digenome_reverse_cutoff=1), "piles")):
        seen.clear()
        got = calling.call(Inputs(reads, contigs), params, checks=False)
        assert got.table.count() >= 0 and got.candidates.count() > 0
        assert seen == [piles, "cut-reads"]
    # only the map of bins is exchanged, by broadcast: two pile-ups' worth of plans, no shuffle in them
    assert len(cuts) == 2 and all("BroadcastExchange" in c and "hashpartitioning" not in c for c in cuts)


def test_bins_of_a_read(spark):
    """A read counts once a bin, and once an endpoint."""
    reads = frame(spark, [read(1000, cigar="100M"), read(1000, flag=17, cigar="100M")])
    places = spark.createDataFrame([("chr1", 1000), ("chr1", 1099)], "contig string, pos long")
    near = sites.cut(reads, places, 0)
    assert sorted((r.flag, r._bin) for r in near.collect()) == [(1, 0), (1, 1), (17, 0), (17, 1)]
    assert sorted(map(tuple, sites.endpoints(near, 1).collect())) == [("chr1", 1000, "+", 1), ("chr1", 1099, "-", 1)]
    assert intervals.BIN == 1024
