"""A sample of one language, and of very unequal ones."""

from pyspark.sql import functions as F

from strandmark.llm import langid


def test_one_language_and_rare_ones(spark):
    rows = [(k, f"some words of one language {k}", "en") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identified(docs, langid.train(docs, F.lit(True))).collect()
    assert {r.lang_pred for r in got} == {"en"} and all(0 <= r.score <= 1 for r in got)
    # an id of very many rows gives the sample one row
    many = docs.union(spark.createDataFrame([(7, f"mots différents encore {k}", "fr") for k in range(500)], docs.schema))
    model = langid.train(many, F.lit(True), sample_rows=60)
    assert set(model.langs) <= {"en", "fr"} and langid.identified(many, model).count() == 560
