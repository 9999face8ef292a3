"""What two sides of a pair or a call are read from is measured once."""

from util import forward, frame, reverse

from strandmark.operators import double_strand, evidence
from strandmark.operators.sites import cut
from strandmark.plans import local_chunks
from strandmark.schema import Params

PARAMS = Params(analysis="digenome", digenome_forward_cutoff=1, digenome_reverse_cutoff=1, digenome_overhang=0)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sides_of_pairs_and_controls_ask_no_reads_again(spark, tmp_path):
    rows = [r for at in range(1000, 9000, 1000) for r in forward(6, at) + reverse(6, at + 1)]
    frame(spark, rows).write.parquet(str(tmp_path / "reads"))
    reads = spark.read.parquet(str(tmp_path / "reads"))
    contigs = spark.createDataFrame([("chr1", 10_000)], "contig string, length long")
    known = double_strand.edges(reads, PARAMS)
    near = cut(reads, double_strand.grid_places(known, 0), PARAMS.artifact_window)
    for metrics in (True, False):
        pairs = double_strand.candidates(near, PARAMS, metrics=metrics, pairs=known)
        assert "_bin" not in plan_of(pairs) and pairs.count() == 8
    _, found = double_strand.calls(reads, contigs, PARAMS)
    tested = evidence.control(evidence.known_indels(found, None, 10), reads, contigs, PARAMS, adjust=False)
    # what is left is the grid of places, which asks for both strands at once
    joins = [line for line in plan_of(tested).splitlines() if "Join" in line and "_bin" in line]
    assert len(joins) == 1 and [r.control_endpoint_count for r in tested.collect()] == [12] * 8


def test_components_of_a_chunk_are_found_once(spark):
    pairs = spark.createDataFrame([("chr1", 10, 11), ("chr1", 12, 11), ("chr1", 50, 51)], "contig string, forward_position long, reverse_position long")
    mine = local_chunks._owned_components(pairs, local_chunks.inside([("chr1", 10, 11)], "forward_position"), 0)
    assert "Window" not in plan_of(mine) and mine.count() == 2
