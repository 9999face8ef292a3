"""Operators on small hand-made reads; expected values follow from the definitions."""

import itertools
import json
import math
import random
import shutil

import pytest
from pyspark.sql import functions as F
from util import covering, forward, frame, read, reverse, reverse_covering

from strandmark.functions import reads as R
from strandmark.functions.statistics import benjamini_hochberg, contribution, fisher_two_sided
from strandmark.operators import double_strand as D
from strandmark.operators import filters, intervals, planner, sinks, sites
from strandmark.plans import calling, chunks
from strandmark.plans.calling import Inputs, call
from strandmark.schema import CALL_COLUMNS, FLOAT_COLUMNS, Params

P = Params(sample="t", ndigenome_min_count=5, ndigenome_ambiguous_min_count=2, digenome_forward_cutoff=4, digenome_reverse_cutoff=4, digenome_depth_cutoff=4, digenome_pair_score_cutoff=1.0, control_min_fold=3.0)


@pytest.fixture(scope="module")
def contigs(spark):
    return spark.createDataFrame([("chr1", 2000)], "contig string, length long")


def called(spark, contigs, rows, params=P, **rest):
    got = call(Inputs(frame(spark, rows), contigs, **rest), params, checks=False).table.collect()
    return sorted(got, key=lambda r: (r.position_0based, r.strand))


def test_cigar_functions(spark):
    rows = frame(spark, [read(100, cigar="5S45M"), read(100, flag=17, cigar="2H20M3D20M5S"), read(300, cigar="5M1I10M2D4N3=1X2P5M")])
    got = rows.select("reference_start", "flag", R.endpoint(), R.five_prime_clip(), R.indel_events(), R.reference_end(), "reference_end").collect()
    assert [(r[2], r[3]) for r in got[:2]] == [(100, 5), (142, 5)]
    assert [tuple(e) for e in got[2][4]] == [(305, "INS", 1), (315, "DEL", 2)]
    assert all(r[5] == r[6] for r in got)


def test_single_strand_break_passes(spark, contigs):
    (row,) = called(spark, contigs, forward(8, 100) + covering(12, 100))
    assert (row.signal_classification, row.filter_status, row.endpoint_count, row.strand_depth) == ("SSB", "PASS", 8, 20)
    assert row.opposite_position_0based is None and row.digenome_pair_score == 0.0 and row.rgen_digenome_score is None


def test_both_strands_are_possible_breaks(spark, contigs):
    rows = called(spark, contigs, forward(8, 100) + reverse(8, 101) + covering(8, 100) + reverse_covering(8, 101))
    assert [(r.strand, r.signal_classification, r.filter_status) for r in rows] == [("+", "POSSIBLE_DSB", "FILTERED"), ("-", "POSSIBLE_DSB", "FILTERED")]


def test_masked_opposite_is_not_seen(spark, contigs):
    mask = spark.createDataFrame([("chr1", 102, 103)], "contig string, start long, end long")
    (row,) = called(spark, contigs, forward(8, 100) + reverse(8, 102), mask=mask)
    assert (row.signal_classification, row.opposite_count, row.opposite_position_0based) == ("SSB", 0, None)


def test_weak_opposite_is_ambiguous(spark, contigs):
    (row,) = called(spark, contigs, forward(8, 100) + reverse(2, 100) + reverse_covering(20, 100))
    assert row.signal_classification == "AMBIGUOUS" and row.filter_reasons == "AMBIGUOUS"


@pytest.mark.parametrize("kw", [{"flag": 1025}, {"flag": 257}, {"flag": 2049}, {"flag": 513}, {"mapq": 0}])
def test_other_reads_make_no_candidate(spark, contigs, kw):
    rows = [read(100, name=str(k), **kw) for k in range(8)]
    assert called(spark, contigs, rows) == []


def test_multimappers_count_when_kept(spark, contigs):
    rows = forward(8, 100, mapq=0) + [read(100, flag=257, mapq=0, name=f"s{k}") for k in range(8)]
    (row,) = called(spark, contigs, rows, P.but(keep_multimappers=True))
    assert (row.endpoint_count, row.secondary_endpoint_count, row.filter_status) == (8, 8, "PASS")


def test_indels_outside_the_window_do_not_count(spark, contigs):
    rows = forward(8, 300) + [read(280, cigar="5M5D30M", name=f"d{k}") for k in range(4)]
    assert called(spark, contigs, rows)[0].indel_read_count == 0
    assert called(spark, contigs, forward(8, 300, cigar="5M1I44M"))[0].indel_type == "INS"


def test_known_indels_and_control(spark, contigs):
    variants = spark.createDataFrame([("chr1", 304, "AA", ["A", "T"]), ("chr1", 305, "A", ["G"])], "contig string, pos long, ref string, alts array<string>")
    control = frame(spark, covering(10, 900))
    (row,) = called(spark, contigs, forward(8, 300), P.but(control_sample="c"), variants=variants, control=control)
    assert row.known_indel_overlap == "chr1:304:AA>A,T" and row.classification == "ARTIFACT_RISK"
    assert row.control_status == "INSUFFICIENT_CONTROL_COVERAGE" and row.control_fisher_q is None and row.control_fold_enrichment is None
    control = frame(spark, covering(20, 300))
    (row,) = called(spark, contigs, forward(8, 300) + covering(4, 300), P.but(control_sample="c"), control=control)
    assert row.control_status == "MATCHED_CONTROL" and row.filter_status == "PASS" and row.control_fisher_q == row.control_fisher_p < 0.05


def test_double_strand_break(spark, contigs):
    rows = called(spark, contigs, forward(8, 500) + reverse(8, 500), P.but(analysis="digenome"))
    assert [(r.signal_classification, r.filter_status, r.forward_position_0based, r.reverse_position_0based) for r in rows] == [("DSB", "PASS", 500, 500)]
    assert rows[0].rgen_digenome_score > 0
    (row,) = called(spark, contigs, forward(8, 600) + reverse(8, 596), P.but(analysis="digenome", digenome_overhang=4, digenome_pair_window=0))
    assert (row.forward_position_0based, row.reverse_position_0based) == (600, 596)
    assert called(spark, contigs, forward(8, 600) + reverse(8, 596), P.but(analysis="digenome")) == []


def test_single_precision_contribution(spark):
    got = spark.range(1).select(F.expr(f"CAST({contribution('10', '20', '8', '16')} AS DOUBLE)"), F.expr(f"CAST({contribution('10', '0', '8', '16')} AS DOUBLE)")).first()
    assert tuple(got) == (3.1499998569488525, 0.0)


def test_assignment_prefers_passing_then_pairs_then_score():
    assert D.best_assignment([(100, 100, True, 10.0), (100, 101, True, 9.0), (101, 100, True, 9.0)]) == [1, 2]
    assert D.best_assignment([(1, 1, True, 1.0), (1, 2, False, 50.0)]) == [0]
    assert D.best_assignment([(0, 0, True, 1.0), (0, 1, True, 1.0), (1, 0, True, 1.0), (1, 1, True, 1.0)]) == [0, 3]


def test_assignment_equals_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        edges = sorted({(rng.randrange(4), rng.randrange(4)) for _ in range(rng.randrange(1, 9))})
        full = [(f, r, rng.random() < 0.5, rng.choice([0.1, 0.3, 1.7])) for f, r in edges]

        def worth(pick):
            return (sum(full[k][2] for k in pick), len(pick), sum(int(full[k][3] * 2**60) for k in pick), -sum(pick), [-k for k in pick] + [1])

        best = max((p for n in range(len(full) + 1) for p in itertools.combinations(range(len(full)), n) if len({full[k][0] for k in p}) == len(p) == len({full[k][1] for k in p})), key=worth)
        got = D.best_assignment(full)
        assert worth(tuple(got))[:4] == worth(best)[:4]


def test_walked_assignment_equals_the_general_one():
    rng = random.Random(9)
    for k in range(400):
        n, w = rng.randrange(2, 14), rng.randrange(1, 4)
        fs, rs = (sorted({rng.randrange(3 * n) for _ in range(n)}) for _ in range(2))
        scores = [0.25, 0.5, 0.5, 1.0] if k % 2 else [rng.random() for _ in range(9)]
        edges = [(f, r, rng.random() < 0.6, rng.choice(scores)) for f in fs for r in rs if abs(f - r) <= w and rng.random() < 0.9]
        if edges:
            assert D.walked_assignment(edges) == D.best_assignment(edges), edges
    # a crowded region takes a moment, not forever
    long = [(f, r, (f * r) % 3 > 0, ((f + 2 * r) % 7) / 8) for f in range(3000) for r in range(max(0, f - 2), f + 3)]
    assert D.most_open(long) <= 6 and len(D.assignment(long)) == 3000


def test_components_equal_connected_ones(spark):
    rng = random.Random(3)
    fs, rs = ({rng.randrange(0, 300) for _ in range(40)} for _ in range(2))
    pairs = sorted(("chr1", f, r) for f in fs for r in rs if abs(f - 2 - r) <= 2)  # all that the window allows
    got = D.components(spark.createDataFrame(pairs, "contig string, forward_position long, reverse_position long"), 2).collect()
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for _, f, r in pairs:
        parent[find(("f", f))] = find(("r", r))
    groups = {}
    for r in got:
        groups.setdefault(r.component, set()).add(find(("f", r.forward_position)))
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len({find(("f", f)) for _, f, _ in pairs})


def test_fisher_and_q_values(spark):
    assert fisher_two_sided(0, 0, 0, 0) == 1.0
    assert math.isclose(fisher_two_sided(3, 1, 1, 3), 0.4857142857142857, rel_tol=1e-9)
    rows = spark.createDataFrame([(k, p) for k, p in enumerate([0.01, 0.04, 0.03, 0.20, None, 0.03])], "id int, p double")
    got = {r.id: r.q for r in benjamini_hochberg(rows, "p", "q", [], ["id"]).collect()}
    assert got[4] is None and got[2] == got[5] == min(0.03 * 5 / 3, 0.05) and math.isclose(got[0], 0.05) and math.isclose(got[3], 0.2)


def test_interval_algebra(spark):
    raw = spark.createDataFrame([("chr1", 100, 200), ("chr1", 150, 250), ("chr1", 250, 275), ("chr2", 10, 20)], "contig string, start long, end long")
    merged = intervals.merge(raw)
    assert sorted(map(tuple, merged.collect())) == [("chr1", 100, 275), ("chr2", 10, 20)]
    assert tuple(intervals.totals(merged).first()) == (2, 185)
    whole = spark.createDataFrame([("chr1", 50, 300), ("chr2", 0, 5)], "contig string, start long, end long")
    assert sorted((r.contig, r.start, r.end) for r in intervals.subtract(whole, merged).collect()) == [("chr1", 50, 100), ("chr1", 275, 300), ("chr2", 0, 5)]
    assert {r.masked_bases for r in intervals.overlap_bases(whole, merged).collect()} == {175, 0}
    points = spark.createDataFrame([("chr1", p) for p in (99, 100, 274, 275)], "contig string, pos long")
    assert sorted(r.pos for r in intervals.outside(points, merged).collect()) == [99, 275]


def test_bins_do_not_change_results(spark, contigs):
    rng = random.Random(1)
    rows = [read(rng.randrange(0, 1900), flag=rng.choice([1, 17]), name=str(k)) for k in range(400)]
    one = {tuple(r) for r in sites.depths(sites.pileups(frame(spark, rows), 1, 1), frame(spark, rows), 1).collect()}
    size, intervals.BIN = intervals.BIN, 64
    try:
        other = {tuple(r) for r in sites.depths(sites.pileups(frame(spark, rows), 1, 1), frame(spark, rows), 1).collect()}
    finally:
        intervals.BIN = size
    assert one == other and len(one) > 300


def test_written_results(spark, contigs, tmp_path):
    got = call(Inputs(frame(spark, forward(8, 100) + covering(12, 100) + forward(8, 700, cigar="5S45M")), contigs), P)
    document = sinks.write(got.table, got.candidates.count(), P, str(tmp_path / "out"))
    assert [document[k] for k in ("reported_candidates", "high_confidence_calls", "manual_review_candidates", "artifact_candidates", "high_confidence_ssb", "high_confidence_dsb")] == [2, 1, 0, 1, 1, 0]
    assert document["classifications"] == {"SSB": 1, "ARTIFACT_RISK": 1} and document["signal_classifications"] == {"SSB": 2} and not document["genome_blacklist"]["enabled"]
    whole = spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "out/all"))
    assert whole.columns == CALL_COLUMNS and whole.count() == 2
    lines = [r.value for r in spark.read.text(str(tmp_path / "out/report")).collect()]
    assert len(lines) == 6 and lines[4].split("\t")[:3] == ["Sample", "Reported candidates", "High-confidence calls"] and lines[5].split("\t") == ["t", "2", "1", "0", "1", "0", "2", "0", "0"]
    with pytest.raises(ValueError, match="repeated"):
        sinks.write(got.table.union(got.table), 0, P, str(tmp_path / "twice"))
    back = spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "out/calls"))
    assert back.columns == [*CALL_COLUMNS, "tier"] and {r.tier for r in back.collect()} == {"high_confidence", "artifact"}
    assert {r.endpoint_fraction for r in back.collect()} == {"0.4", "1"}
    assert len(FLOAT_COLUMNS) == 20 and got.table.columns == CALL_COLUMNS
    assert sinks.bed(got.table).first().score == 400
    assert {r[0] for r in got.table.select(filters.tier()).collect()} == {"high_confidence", "artifact"}


def test_no_reads_no_calls(spark, contigs):
    for analysis in ("ndigenome", "digenome"):
        assert called(spark, contigs, [], P.but(analysis=analysis)) == []


def test_inputs_are_checked(spark, contigs):
    good, far = forward(8, 100), spark.createDataFrame([("chr1", 3000)], "contig string, length long")
    single = [read(100, flag=0, name=str(k)) for k in range(8)]
    mask = spark.createDataFrame([("chr1", 1990, 2001)], "contig string, start long, end long")
    ordered = contigs.withColumn("ordinal", F.lit(0))
    whole = lambda **kw: Inputs(frame(spark, good), ordered, **kw)
    call(whole(control=frame(spark, good), control_contigs=ordered, variant_contigs=contigs), P)
    for inputs, message in (
        (Inputs(frame(spark, []), contigs), "no eligible"), (Inputs(frame(spark, single), contigs), "paired"), (whole(control=frame(spark, [])), "no eligible"), (whole(control_contigs=far.withColumn("ordinal", F.lit(0))), "different contigs"),
        (whole(variant_contigs=far), "other lengths"), (whole(variant_contigs=far.where("contig = 'x'")), "lacks contigs"), (whole(mask=mask), "outside"),
    ):
        with pytest.raises(ValueError, match=message):
            call(inputs, P)
    call(Inputs(frame(spark, single), contigs), P.but(analysis="digenome"))


def test_chunks_give_the_calls_of_one_run(spark, tmp_path):
    contigs = spark.createDataFrame([("chr1", 2000), ("chr2", 2000)], "contig string, length long")
    rows = forward(8, 100) + covering(12, 100) + forward(8, 700, cigar="5S45M") + forward(6, 400, contig="chr2") + forward(9, 1500, contig="chr2")
    inputs = Inputs(frame(spark, rows), contigs, control=frame(spark, forward(2, 100) + covering(9, 100)))
    params = P.but(control_sample="c")
    want = call(inputs, params).table.collect()
    plan = planner.plan(sites.contig_density(inputs.reads), contigs, 3)
    candidates, found = calling.rows(inputs, params)
    chunks.write_chunks(found, candidates, plan, contigs, params, str(tmp_path / "a"))
    got, n = chunks.finalised(spark, str(tmp_path / "a"), params)
    assert sorted(map(str, got.collect())) == sorted(map(str, want)) and len(want) == 4 and n == candidates.count()
    with pytest.raises(ValueError, match="another sample"):
        chunks.finalised(spark, str(tmp_path / "a"), params.but(sample="u"))

    def changed(change, name):
        folder = tmp_path / name
        shutil.copytree(tmp_path / "a", folder)
        for path in sorted((folder / "summaries").glob("part-*")):
            documents = [json.loads(x) for x in path.read_text().splitlines()]
            for document in documents:
                change(document)
            path.write_text("".join(json.dumps(document) + "\n" for document in documents))
        for crc in folder.rglob("*.crc"):
            crc.unlink()
        return str(folder)

    def shifted(d):
        for x in d["intervals"]:
            x["end"] -= x["end"] == 2000

    def moved(d):
        d["chunk_id"] = {"chunk_000": "chunk_001", "chunk_001": "chunk_000"}.get(d["chunk_id"], d["chunk_id"])

    cases = [(lambda d: d.update(reported_rows=9), "reported"), (shifted, "leave out"), (moved, "outside their chunk"), (lambda d: d.update(chunk_id="x"), "repeated chunk"), (lambda d: d["parameters"].update(sample=d["chunk_id"]), "parameters"), (lambda d: d.update(contigs=["chr9"]), "disagree"), (lambda d: d.update(expected_contig_lengths={}), "length")]
    for k, (change, message) in enumerate(cases):
        with pytest.raises(ValueError, match=message):
            chunks.finalised(spark, changed(change, f"b{k}"), params)
