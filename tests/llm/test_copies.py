"""Groups of many copies in the pipeline: one text of each comes out."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from strandmark.llm import lines


def made(rng, n_lines):
    return [" ".join("w" + str(rng.randrange(10**5)) for _ in range(12)) for _ in range(n_lines)]


def test_lines_of_copies_stay_once_and_boilerplate_goes(spark):
    rng = random.Random(3)
    exact, near = made(rng, 8), made(rng, 20)
    texts = {k: exact for k in range(12)}
    for k in range(12):
        texts[100 + k] = [f"edit {k}" if i == k else x for i, x in enumerate(near)]
    for k in range(15):
        texts[200 + k] = [*made(rng, 5), "All rights reserved"]
    texts[300] = ["all rights reserved "]
    docs = spark.createDataFrame([(i, "\n".join(t)) for i, t in texts.items()], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in lines.dedup_lines(docs, 10, policy="boilerplate").collect()}
    assert got[0].text == "\n".join(exact) and {got[k].text for k in range(1, 12)} == {""}
    whole = "\n".join(got[100 + k].text for k in range(12)).split("\n")
    assert all(whole.count(x) >= 1 for x in near)
    assert all(got[200 + k].text == "\n".join(texts[200 + k][:-1]) and got[200 + k].n_dropped == 1 for k in range(15)) and got[300].text == ""


def test_pipeline_keeps_one_text_of_each_large_group(spark, tmp_path):
    rng = random.Random(5)
    groups = ["\n".join(made(rng, 6)) for _ in range(2)]
    rows = [(100 * g + k, t) for g, t in enumerate(groups) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, 0)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        now = stage(spark, now, str(tmp_path))
    assert sorted(r.text for r in now.collect() if r.text) == sorted(groups)
    assert corpus_pipeline.run(spark, str(tmp_path)).where("length > 20").select("doc_id").distinct().count() == 2
