"""The training-corpus pipeline: each stage takes and gives documents (doc_id, text, lang, source, n_chars).

A stage's rows are written as Parquet and reread as the next one's ``docs``. Texts that a stage cuts keep their
document; ``n_chars`` then counts the characters that are left.

* toxicity: scores by boosted trees fitted on labelled rows (a bounded sample); predicted toxic documents go.
* line dedup: of lines whose key is in at least ``LINE_DOCS`` of the documents the first stays; where so many documents
  of mostly other text hold the key, it's boilerplate and goes from all of them.
* SimHash near-dedup: five-word shingles; of documents that are linked the one of smallest id stays.
* suffix dedup: passages of 50 bytes that a document of smaller id has as well go.
* packing: pieces of all documents in sequences of at most 4096 tokens.

Edge cases are those of the operators (strandmark.llm); documents whose text is empty after a cut stay,
but near-dedup takes those without any word for copies of each other, so one of them is left after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmark.llm import base, lines, packing, simhash, suffixes, toxicity

LINE_DOCS = 10
#: No SQL here: trained trees, fingerprints and tokenizers are beyond it; the stages are tested against brute force.
ORACLE_SQL = None


def _recounted(docs: DataFrame, like: DataFrame) -> DataFrame:
    if "n_chars" in like.columns:
        docs = docs.withColumn("n_chars", F.char_length("text").cast(like.schema["n_chars"].dataType))
    return docs.select(like.columns)


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs, labels, F.lit(True))
    return toxicity.scored(docs, model).where("predicted = 0").select(docs.columns)


def lines_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(lines.dedup_lines(docs, LINE_DOCS, policy="boilerplate"), docs)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, width=5).select(docs.columns)


def passages_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(suffixes.without_repeats(docs), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs.select("doc_id", "text"), 4096, "word_bpe_49k.json", True, 1).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", toxic_out),
    ("line dedup", lines_out),
    ("simhash near-dedup", near_copies_out),
    ("suffix-array dedup", passages_out),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = base.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
