"""The jobs on small and growing inputs: what is new is taken once, reruns leave the same rows, nobody else's folders change."""

import hashlib
import subprocess
import sys
from pathlib import Path

import pytest
from util import covering, forward, frame, reverse, reverse_covering

from jobs import cleavage_calls, lane_intake
from strandmark.operators import intake

TEXTS = "doc_id long, text string, source string"


def put(spark, folder, name, rows):
    spark.createDataFrame(rows, TEXTS).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def by_id(df):
    return {r.id: (r.status, r.reuse_of, r.batch) for r in df.collect()}


@pytest.fixture
def place(tmp_path):
    return [str(tmp_path / x) for x in ("texts", "out", "checkpoint")]


FIRST = [(5, "ACGTTGCA\nGATTACA", "007"), (3, "ACGTTGCA\nGATTACA", "L2"), (8, "", "L2"), (9, None, None), (10, " \n\t", ""), (11, "AAAAAAAAAAAAC", "L1"), (12, "x", "L1"), (13, "only here é\n", "L1"), (None, "no id", "L1")]
SECOND = [(1, "ACGTTGCA\nGATTACA", "L3"), (13, "only here é\n", "L1"), (20, "new text", "007"), (20, "new text", "007"), (21, "no id", "L1"), (22, "AAAAAAAAAAAAC", "L9"), (23, "", "L9")]


def test_intake_takes_what_is_new(spark, place):
    texts, out, checkpoint = place
    put(spark, texts, "", FIRST)
    lane_intake.run(spark, texts, out, checkpoint)
    one = lane_intake.registry(spark, out)
    assert by_id(one) == {5: ("reused", 3, 0), 3: ("accepted", None, 0), 8: ("blank", None, 0), 9: ("blank", None, 0), 10: ("blank", None, 0), 11: ("low_complexity", None, 0), 12: ("accepted", None, 0), 13: ("accepted", None, 0), None: ("accepted", None, 0)}
    assert {r.id: r.lane for r in one.collect()} == {5: "007", 3: "L2", 8: "L2", 9: "none", 10: "none", 11: "L1", 12: "L1", 13: "L1", None: "L1"}
    before = rows_of(one)
    lane_intake.run(spark, texts, out, checkpoint)
    assert rows_of(lane_intake.registry(spark, out)) == before
    put(spark, texts, "", SECOND)
    lane_intake.run(spark, texts, out, checkpoint)
    both = lane_intake.registry(spark, out)
    assert rows_of(both.where("batch = 0")) == before
    new = both.where("batch = 1")
    assert by_id(new) == {1: ("reused", 3, 1), 13: ("reused", 13, 1), 20: ("accepted", None, 1), 21: ("reused", None, 1), 22: ("reused", 11, 1), 23: ("blank", None, 1)}
    assert new.count() == len(SECOND)
    lanes = {r.lane: r for r in spark.read.parquet(f"{out}/lanes").collect()}
    assert (lanes["007"].n_texts, lanes["007"].n_accepted, lanes["007"].n_reused) == (3, 2, 1) and lanes["L9"].n_blank == 1
    assert sum(r.n_texts for r in lanes.values()) == len(FIRST) + len(SECOND)


def test_a_batch_taken_again_replaces_itself(spark, place):
    _, out, _ = place
    config = lane_intake.config_of(lane_intake.DEFAULTS, None)
    df = spark.createDataFrame(FIRST, TEXTS)
    for _ in range(2):
        lane_intake.take(df, 0, out, config)
        lane_intake.take(spark.createDataFrame(SECOND, TEXTS), 1, out, config)
    assert lane_intake.registry(spark, out).count() == len(FIRST) + len(SECOND)
    # the first batch again, with others behind it: it looks at nothing but earlier ones
    before = rows_of(lane_intake.registry(spark, out))
    lane_intake.take(df, 0, out, config)
    assert rows_of(lane_intake.registry(spark, out)) == before


def test_files_one_by_one(spark, place):
    texts, out, checkpoint = place
    for k in range(4):
        put(spark, texts, "", [(k, f"text {k % 2}", "L")])
    lane_intake.run(spark, texts, out, checkpoint, {"files_a_batch": 1})
    got = lane_intake.registry(spark, out)
    assert sorted(r.batch for r in got.collect()) == [0, 1, 2, 3] and [r.status for r in got.orderBy("batch").collect()].count("accepted") == 2


def test_empty_table_and_wrong_config(spark, place):
    texts, out, checkpoint = place
    put(spark, texts, "", [])
    lane_intake.run(spark, texts, out, checkpoint)
    found = lane_intake.registry(spark, out)
    assert found is None or found.count() == 0
    with pytest.raises(ValueError, match="least_complexitty"):
        lane_intake.run(spark, texts, out, checkpoint, {"least_complexitty": 3})


def test_described(spark):
    texts = ["", "a", "aa", "ab", "aab\n", "\n\n", "\U0001f600\U0001f600é", "x" * 50_000 + "y"]
    got = {r.id: r for r in intake.described(spark.createDataFrame(list(enumerate(texts)), "k long, t string").selectExpr("k", "t", "'l' as l"), "k", "t", "l").collect()}
    for k, t in enumerate(texts):
        changes = sum(a != b for a, b in zip(t, t[1:]))
        assert got[k].sha256 == hashlib.sha256(t.encode()).hexdigest() and got[k].n_bytes == len(t.encode())
        assert got[k].n_lines == len(t.split("\n")) - (t == "" or t.endswith("\n"))
        assert got[k].complexity == pytest.approx(100 * changes / (len(t) - 1) if len(t) > 1 else 100)


def test_command_line(spark, place):
    texts, out, checkpoint = place
    put(spark, texts, "", FIRST)
    root = Path(__file__).resolve().parent.parent
    command = [sys.executable, "-m", "jobs.lane_intake", "--texts", texts, "--out", out, "--checkpoint", checkpoint]
    done = subprocess.run(command, cwd=root, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "read 9 texts, wrote" in done.stderr
    assert lane_intake.registry(spark, out).count() == len(FIRST)


SITE = {"thresholds": {"ndigenome_min_count": 4, "digenome_forward_cutoff": 2, "digenome_reverse_cutoff": 2, "digenome_depth_cutoff": 4}, "analyses": ["ndigenome", "digenome"], "sample": "s1"}


def tables(spark, folder, mapq=60):
    rows = forward(8, 500, mapq=mapq) + reverse(8, 500, mapq=mapq) + covering(5, 500) + reverse_covering(5, 500) + forward(9, 900, mapq=mapq) + covering(6, 900)
    frame(spark, rows).write.parquet(f"{folder}/reads")
    frame(spark, covering(9, 500) + reverse_covering(9, 500) + covering(9, 900)).write.parquet(f"{folder}/control")
    spark.createDataFrame([("chr1", 5000)], "contig string, length long").write.parquet(f"{folder}/contigs")
    return str(folder)


def test_calls_again_leave_the_same(spark, tmp_path):
    where, out = tables(spark, tmp_path / "t"), str(tmp_path / "out")
    wrote = cleavage_calls.run(spark, where, out, SITE | {"control_sample": "c"})
    first = rows_of(cleavage_calls.calls(spark, out))
    assert sum(wrote.values()) == len(first) > 2 and set(wrote) == {"ndigenome", "digenome"}
    again = cleavage_calls.run(spark, where, out, SITE | {"control_sample": "c", "analyses": ["ndigenome"]})
    assert again == {"ndigenome": wrote["ndigenome"]}
    assert rows_of(cleavage_calls.calls(spark, out)) == first
    counts = {(r.analysis, r.kind, r.value): r.n for r in spark.read.json(f"{out}/qc").collect()}
    assert counts["ndigenome", "reported", "all"] == wrote["ndigenome"] and counts["digenome", "candidates", "all"] >= wrote["digenome"]
    # another sample stands beside the first, which stays as it was
    cleavage_calls.run(spark, where, out, SITE | {"sample": "s2", "analyses": ["ndigenome"]})
    both = cleavage_calls.calls(spark, out)
    assert rows_of(both.where("sample = 's1'")) == first and both.where("sample = 's2'").count() > 0
    assert {r.tier for r in both.select("tier").distinct().collect()} <= {"high_confidence", "manual_review", "artifact"}


def test_a_tier_that_runs_empty_leaves_nothing(spark, tmp_path):
    where, out = tables(spark, tmp_path / "t"), str(tmp_path / "out")
    site = SITE | {"analyses": ["ndigenome"]}
    cleavage_calls.run(spark, where, out, site)
    assert cleavage_calls.calls(spark, out).where("tier = 'high_confidence'").count() > 0
    strict = SITE["thresholds"] | {"min_support_mean_mapq": 99.0}
    cleavage_calls.run(spark, where, out, site | {"thresholds": strict})
    assert {r.tier for r in cleavage_calls.calls(spark, out).select("tier").distinct().collect()} == {"artifact"}
    assert spark.read.csv(f"{out}/bed/analysis=ndigenome/sample=s1", sep="\t", schema="c string").count() == 0


def test_inputs_are_checked(spark, tmp_path):
    where = tables(spark, tmp_path / "t")
    with pytest.raises(ValueError, match="no eligible"):
        frame(spark, forward(3, 10, mapq=0)).write.mode("overwrite").parquet(f"{where}/reads")
        cleavage_calls.run(spark, where, str(tmp_path / "o"), SITE)
    (tmp_path / "t" / "control").rename(tmp_path / "t" / "away")
    with pytest.raises(ValueError, match="control"):
        cleavage_calls.run(spark, where, str(tmp_path / "o"), SITE | {"control_sample": "c"})
