"""The stream in coordinate order: counts equal the batch's, the state holds open places only, disorder fails."""

import random
import time

import pyarrow as pa
import pytest
from pyspark.errors import StreamingQueryException
from util import frame, read

from strandmark.operators import sites
from strandmark.plans import registry
from strandmark.schema import READ_SCHEMA
from strandmark.streaming import ordered


def scene(n=600):
    rng = random.Random(7)
    rows = []
    for k in range(n):
        at = rng.randrange(0, 4000)
        rows.append(read(at, flag=rng.choice([0, 16, 16, 4, 1024, 2048]), cigar=rng.choice(["50M", "20M3D30M", "5S45M"]), mapq=rng.choice([0, 20, 60]), contig=rng.choice(["chr1", "chr2"]), name=f"q{k}"))
    return rows


def put(spark, folder, rows):
    spark.createDataFrame(rows, READ_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    time.sleep(0.05)


def rows_of(df):
    return sorted(map(tuple, df.select("contig", "pos", "strand", "count").collect()))


def test_equals_the_batch_with_a_bounded_state(spark, tmp_path):
    where = [str(tmp_path / x) for x in ("in", "out", "checkpoint")]
    rows = sorted(frame(spark, scene()).collect(), key=lambda r: (r.reference_start, r.read_ord))
    rows = [(k, *r[1:]) for k, r in enumerate(rows)]
    every = spark.createDataFrame(rows, READ_SCHEMA)
    want = rows_of(sites.endpoints(every, 1))
    cuts = [0, 90, 250, 251, 480, len(rows)]
    for a, b in zip(cuts, cuts[1:]):
        put(spark, where[0], rows[a:b])
        ordered.run(spark, *where).awaitTermination()
        held = spark.read.format("statestore").load(where[2]).select("value.groupState.*").collect() if b < len(rows) else []
        for state in held:
            assert all(p // 2 >= state.start for p in state.place)
            assert len(state.place) <= sum(1 for r in rows[:b] if r[5] > state.start)
        # nothing is given out twice, and all that is given out is right already
        got = rows_of(ordered.final(spark, where[1], 1))
        assert set(got) <= set(want) and len(set(got)) == len(got)
    assert len(got) > 0.9 * len(want)
    ordered.ended(spark, ["chr1", "chr2"]).coalesce(1).write.mode("append").parquet(where[0])
    ordered.run(spark, *where).awaitTermination()
    assert rows_of(ordered.final(spark, where[1], 1)) == want
    assert rows_of(ordered.final(spark, where[1], 2)) == [r for r in want if r[3] >= 2]
    assert all(not r.place for r in spark.read.format("statestore").load(where[2]).select("value.groupState.*").collect())


@pytest.mark.parametrize("files", [[[100, 90]], [[100, 200], [150]], [[100], [], [99]], [[100], None, [300]]], ids=["within", "between", "later", "after its end"])
def test_reads_that_go_back_fail(spark, tmp_path, files):
    where = [str(tmp_path / x) for x in ("in", "out", "checkpoint")]
    order = 0
    for starts in files:
        if starts is None:
            ordered.ended(spark, ["chr1"]).coalesce(1).write.mode("append").parquet(where[0])
        else:
            put(spark, where[0], [(order + k, *read(at)) for k, at in enumerate(starts)])
            order += len(starts)
    with pytest.raises(StreamingQueryException, match="not sorted|after its end"):
        ordered.run(spark, *where).awaitTermination()


def test_a_piece_lies_in_one_part_of_a_file():
    """A task's rows may be of files with another one between them."""
    columns = {"contig": ["chr1"] * 4, "split": [1, 1, 3, 3], "ord": [0, 1, 20, 21], "start": [5, 6, 50, 51], "place": [10, 12, 100, 102], "counts": [True] * 4}
    got = [r for b in ordered.pieces(iter([pa.RecordBatch.from_pydict(columns)])) for r in b.to_pylist()]
    assert [(r["first_start"], r["last_start"]) for r in got] == [(5, 6), (50, 51)]


def test_more_reads_are_more_files_that_are_taken_several_at_once(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(registry, "READS_A_FILE", 100, raising=False)
    monkeypatch.setattr(registry, "new_folder", lambda spark, name: f"file://{tmp_path}/{name}")
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    found = registry.ordered_pileups(spark, "/root/testdata/sf0.001")
    assert spark.conf.get("spark.sql.shuffle.partitions") == usual
    files = spark.read.parquet(f"file://{tmp_path}/ordered/in").where("reference_start IS NOT NULL").selectExpr("input_file_name() AS f").groupBy("f").count().collect()
    assert len(files) > 30 and max(r["count"] for r in files) <= 100
    batches = len(list((tmp_path / "ordered/checkpoint/commits").glob("[0-9]*")))
    assert batches < len(files) / 6
    want = registry.endpoint_pileups(spark, "/root/testdata/sf0.001")
    assert rows_of(found) == rows_of(want)
