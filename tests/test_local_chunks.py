"""Chunks called by themselves: the same rows as the whole call, from reads near them only."""

import random

import pytest
from pyspark.sql import functions as F
from util import covering, forward, frame, reverse, reverse_covering

from strandmark.operators import double_strand
from strandmark.plans import calling, chunks, local_chunks
from strandmark.plans.calling import Inputs
from strandmark.plans.local_chunks import Interval
from strandmark.schema import Params
from strandmark.sources import formats

DSB = Params(analysis="digenome", digenome_forward_cutoff=2, digenome_reverse_cutoff=2, digenome_depth_cutoff=3, digenome_fraction_cutoff=0.05, digenome_pair_score_cutoff=0.05, control_sample="c")
SSB = Params(analysis="ndigenome", ndigenome_min_count=4, ndigenome_min_fraction=0.05, control_sample="c")


def contigs(spark, length=2000):
    return spark.createDataFrame([("chr1", length), ("chr2", length)], "contig string, length long")


def rows_of(df):
    return sorted((tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect()))


def chunked(spark, inputs, owned, params, folder):
    for k, own in enumerate(owned, len(OWNED) - len(owned)):
        candidates, found, _ = local_chunks.call(inputs, own, params)
        chunks.write_chunk(f"chunk_{k:03d}", candidates, found, [(x.contig, x.start, x.end) for x in own], params, {"chr1": 2000, "chr2": 2000}, folder)
    return chunks.finalised(spark, folder, params)


def scene(spark):
    rng = random.Random(4)
    rows = []
    for contig in ("chr1", "chr2"):
        for at in sorted(rng.sample(range(100, 1900), 30)) + [995, 998, 1000, 1002]:
            rows += forward(rng.randint(2, 6), at, contig=contig) + reverse(rng.randint(2, 6), at + rng.randint(-2, 2), contig=contig)
    reads = frame(spark, [[f"{k}", *r[1:]] for k, r in enumerate(rows)])
    control = frame(spark, [[f"c{k}", *r[1:]] for k, r in enumerate(rows[::3])])
    variants = spark.createDataFrame([("chr1", 1001, "A", ["AT"])], "contig string, pos long, ref string, alts array<string>")
    mask = spark.createDataFrame([("chr2", 400, 480)], "contig string, start long, end long")
    return Inputs(reads, contigs(spark), control, variants, mask)


OWNED = [[Interval("chr1", 0, 1000, 0, 1010), Interval("chr2", 997, 2000, 987, 2000)], [Interval("chr1", 1000, 2000, 990, 2000), Interval("chr2", 0, 997, 0, 1007)]]


@pytest.mark.parametrize("params", [SSB, DSB.but(digenome_overhang=2)], ids=["single", "double"])
def test_chunks_together_are_the_whole_call(spark, tmp_path, params):
    inputs = scene(spark)
    whole = calling.call(inputs, params, checks=False)
    # the second chunk a second time: it replaces its own rows
    for owned in (OWNED, OWNED[1:]) if params is SSB else (OWNED,):
        table, candidates = chunked(spark, inputs, owned, params, str(tmp_path / "out"))
    assert rows_of(table) == rows_of(whole.table) and table.count() > 20
    assert candidates == whole.candidates.count()


def test_a_chain_is_followed_beyond_the_padding(spark):
    """A chain of conflicts from 900 to 1100, cut at 1000; the scanned interval reaches 6 bases only."""
    rows = [r for at in range(900, 1101, 2) for r in forward(5, at) + reverse(5, at)] + forward(5, 300) + reverse(5, 300)
    reads = frame(spark, rows)
    for overhang, start in ((0, 1000), (4, 1050)):
        params = DSB.but(control_sample="", digenome_overhang=overhang)
        pairs, scanned, widened = local_chunks.closed(reads, {"chr1": 2000, "chr2": 2000}, [Interval("chr1", start, 2000, start - 6, 2000)], params)
        every = double_strand.edges(reads, params)
        assert rows_of(pairs) == rows_of(every.where("forward_position > 400")) and len(scanned) == 1
        assert 3 <= widened <= 8 and 700 < scanned[0][1] < 900


def test_only_near_reads_are_read(spark, tmp_path):
    """Of stored reads only files of the scanned places are opened, and other reads don't matter."""
    rows = [r for at in range(40, 1900, 20) for r in forward(4, at) + reverse(4, at) + covering(1, at) + reverse_covering(1, at)]
    path = str(tmp_path / "stored")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        formats.store_reads(frame(spark, rows), path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = spark.read.parquet(path)
    own = [Interval("chr1", 800, 1000, 790, 1010)]
    _, found, looked = local_chunks.call(Inputs(stored, contigs(spark)), own, DSB.but(control_sample=""))
    assert looked[0][1] > 700 and looked[0][2] < 1100
    cut = stored.where(local_chunks.near(looked))
    opened = {r[0] for r in cut.select(F.input_file_name()).distinct().collect()}
    assert "LessThan(reference_start" in cut._jdf.queryExecution().executedPlan().toString() and len(opened) < len(stored.inputFiles()) / 2
    # with all other reads away the rows stay the same
    alone = local_chunks.call(Inputs(spark.createDataFrame(cut.collect(), stored.schema), contigs(spark)), own, DSB.but(control_sample=""))[1]
    assert rows_of(found) == rows_of(alone) and found.count() >= 8
