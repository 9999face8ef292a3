from strandmark.plans import registry


def test_more_reads_arrive_as_more_files(spark, monkeypatch, tmp_path):
    """A stream's files hold a bounded number of reads each."""
    monkeypatch.setattr(registry, "READS_A_FILE", 500, raising=False)
    monkeypatch.setattr(registry, "new_folder", lambda spark, name: f"file://{tmp_path}/{name}")
    found = registry.streamed_pileups(spark, "/root/testdata/sf0.001")
    files = spark.read.parquet(f"file://{tmp_path}/stream/in").selectExpr("input_file_name() AS f").groupBy("f").count().collect()
    assert len(files) > 3 and max(r["count"] for r in files) <= 500
    want = registry.endpoint_pileups(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
