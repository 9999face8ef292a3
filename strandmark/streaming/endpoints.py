"""Endpoint pile-ups of a growing folder of reads, by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandmark.functions import reads as R
from strandmark.operators.sites import SITE
from strandmark.schema import READ_SCHEMA


def endpoint_counts(spark: SparkSession, folder: str, min_mapq: int) -> DataFrame:
    """(contig, pos, strand, count) over all files so far; order of arrival doesn't matter, so nothing is ever late.

    A position may get reads at any time, so its count stays in the state; the state store may keep it on disk.
    """
    stream = spark.readStream.schema(READ_SCHEMA).parquet(folder)
    return stream.where(R.eligible(min_mapq)).groupBy("contig", R.endpoint().alias("pos"), R.strand().alias("strand")).agg(F.count("*").alias("count"))


def run(counts: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Writes the counts that a batch has changed to ``out/batch=...``, once however often the batch is tried; stops when all
    present files are read. A later run with the same checkpoint goes on from there."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return counts.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, out: str, min_count: int) -> DataFrame:
    """The pile-ups so far: counts only grow, so the greatest of a position's counts is its latest."""
    return spark.read.parquet(out).groupBy(*SITE).agg(F.max("count").alias("count")).where(F.col("count") >= min_count)


def compact(spark: SparkSession, out: str, into: str) -> None:
    """The latest count of each position as one batch in another folder."""
    current(spark, out, 1).write.parquet(f"{into}/batch=0")
