from pyspark.sql import functions as F

from strandmark import session
from strandmark.operators import double_strand, single_strand
from strandmark.schema import Params
from strandmark.session import by_rows, written
from util import forward, frame, reverse


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_written_tables_of_many_rows_are_merged_however_small_their_files(spark, tmp_path, monkeypatch):
    """Sites, their reads and pairs are broadcast by no join once they have many rows: the driver would hold them."""
    monkeypatch.setattr(session, "MOST_BROADCAST", 3, raising=False)
    rows = [r for at in range(1000, 9000, 1000) for r in forward(6, at) + reverse(6, at + 1)]
    frame(spark, rows).write.parquet(str(tmp_path / "reads"))
    reads = spark.read.parquet(str(tmp_path / "reads"))
    params = Params(ndigenome_min_count=3, ndigenome_min_fraction=0.05)
    found = single_strand.calls(reads, params)[1]
    assert "BroadcastHashJoin" not in plan_of(found) and found.count() == 16
    params = params.but(analysis="digenome", digenome_forward_cutoff=1, digenome_reverse_cutoff=1)
    pairs = double_strand.candidates(reads, params, metrics=False, pairs=double_strand.edges(reads, params))
    joins = [line for line in plan_of(pairs).splitlines() if "BroadcastHashJoin" in line]
    assert not any("_bin" in line for line in joins) and pairs.count() == 8  # neither the reads nor their places


def test_few_rows_may_be_broadcast(spark):
    few = by_rows(written(spark.range(10), "few"))
    assert few._written_to and "BroadcastHashJoin" in plan_of(spark.range(1_000_000).join(few, "id"))


def test_wide_rows_are_merged_where_as_many_slim_ones_may_be_broadcast(spark, tmp_path):
    """Rows of sixty columns fill a broadcast long before rows of two do."""
    slim = by_rows(written(spark.range(20_000).withColumn("a", F.col("id") % 7), "slim"))
    wide = by_rows(written(spark.range(20_000).withColumns({f"a{k}": F.col("id") % 7 for k in range(60)}), "wide"))
    spark.range(5_000_000).write.parquet(str(tmp_path / "many"))
    many = spark.read.parquet(str(tmp_path / "many"))
    assert "BroadcastHashJoin" in plan_of(many.join(slim, "id"))
    assert "BroadcastHashJoin" not in plan_of(many.join(wide, "id"))
