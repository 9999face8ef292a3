"""Job 2, incremental: the registry of arriving texts (lane files as rows of a table), with digests, reuse and fitness.

    python -m jobs.lane_intake --texts FOLDER --out FOLDER --checkpoint FOLDER [--config FILE]

No input may be used twice and none may be blank; low-complexity ones are set aside. A run takes the
files of the table that earlier runs haven't taken (a file stream with its checkpoint), and ends when they are registered:

    registry/batch=N/lane=L/...    a row a text: id, sha256, n_bytes, n_lines, blank, complexity, reuse_of, status (Parquet)
    lanes                          texts and bytes by lane and state, of the registry as it stands (Parquet)

Reruns: a batch that broke off is taken again under its number and replaces its own folder; what is registered isn't touched. ``lanes`` is
rewritten from the registry at each end, so it's right after a break too. Contents are compared with all that was registered
in earlier batches, by digest. A text that comes again in a file of its own is a reuse, also under its own id.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import LOG, command_line, config_of
from strandmark.operators import intake
from strandmark.session import discard, new_folder, written

CONFIG = Path(__file__).with_suffix(".json")
DEFAULTS = {"id": "doc_id", "text": "text", "lane": "source", "least_complexity": 30.0, "files_a_batch": 0}


#: Of the registry but for the id, whose type is the table's; lanes are text, however they look as names of folders.
COLUMNS = "sha256 string, n_bytes long, n_lines long, blank boolean, complexity double, reuse_of {0}, status string, batch long, lane string"


def registry(spark: SparkSession, out: str, before: int | None = None, id_type: str = "bigint") -> DataFrame | None:
    """All registered rows, or those of batches before a number; None where nothing has been registered."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/registry")
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    kept = spark.read.schema(f"id {id_type}, {COLUMNS.format(id_type)}").option("basePath", f"{out}/registry").parquet(f"{out}/registry")
    return kept if before is None else kept.where(F.col("batch") < before)


def take(batch: DataFrame, number: int, out: str, config: dict) -> None:
    """Registers one batch under its number."""
    spark = batch.sparkSession
    # written once: the batch is read from its files a single time, and texts aren't carried further
    new = written(intake.described(batch, config["id"], config["text"], config["lane"]), "intake")
    before = registry(spark, out, number, new.schema["id"].dataType.simpleString())
    earlier = None
    if before is not None:
        # the batch that had a content first names its owner
        first = before.where("status IN ('accepted', 'low_complexity')").groupBy("sha256").agg(F.min(F.struct("batch", "id")).alias("f"))
        earlier = first.select("sha256", F.col("f.id").alias("first"))
    rows = intake.judged(new, earlier, config["least_complexity"])
    place = f"{out}/registry/batch={number}"
    rows.write.mode("overwrite").partitionBy("lane").parquet(place)
    counts = {r["status"]: r["n"] for r in spark.read.schema(rows.schema).parquet(place).groupBy("status").agg(F.count("*").alias("n")).collect()}  # a row a state
    LOG.info("batch %d: read %d texts, wrote %s: %s", number, sum(counts.values()), place, ", ".join(f"{n} {s}" for s, n in sorted(counts.items())))
    discard(new)


def _listed(spark: SparkSession, path: str) -> str:
    """A path that a file stream takes: a folder as it is, a single file as a pattern that only it fits."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return f"{path[:-1]}[{path[-1]}]" if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isFile() else path


def run(spark: SparkSession, texts: str, out: str, checkpoint: str, config: dict | None = None) -> None:
    """Takes what is new in the table of texts; returns when it's registered."""
    config = config_of(DEFAULTS, config)
    schema = spark.read.parquet(texts).schema
    reader = spark.readStream.schema(schema)
    if config["files_a_batch"]:
        reader = reader.option("maxFilesPerTrigger", config["files_a_batch"])
    stream = reader.parquet(_listed(spark, texts)).select(*dict.fromkeys(config[k] for k in ("id", "text", "lane")))
    started = stream.writeStream.foreachBatch(lambda df, number: take(df, number, out, config)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    started.awaitTermination()
    LOG.info("%s: %d batches were new", texts, sum(1 for p in started.recentProgress if p["numInputRows"]))
    found = registry(spark, out, id_type=schema[config["id"]].dataType.simpleString())
    if found is not None:
        intake.by_lane(found).coalesce(1).write.mode("overwrite").parquet(f"{out}/lanes")


def job2_lane_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run twice into one folder with one checkpoint; the whole registry as it stands then."""
    from jobs.common import read_config

    out = new_folder(spark, "job2", keep=True)
    for _ in range(2):
        run(spark, f"{sf_dir}/documents.parquet", f"{out}/out", f"{out}/checkpoint", read_config(CONFIG))
    rows = registry(spark, f"{out}/out")
    return rows.select("id", "lane", "sha256", "n_bytes", "n_lines", "blank", F.round("complexity", 6).alias("complexity"), "reuse_of", "status")


SQL = r"""
WITH t AS (SELECT doc_id AS id, coalesce(nullif(source, ''), 'none') AS lane, coalesce(text, '') AS t FROM documents),
d AS (SELECT id, lane, sha256(t) AS sha256, CAST(octet_length(encode(t)) AS BIGINT) AS n_bytes,
        CAST(CASE WHEN t = '' THEN 0 ELSE length(t) - length(replace(t, chr(10), '')) + (CASE WHEN ends_with(t, chr(10)) THEN 0 ELSE 1 END) END AS BIGINT) AS n_lines,
        NOT regexp_matches(t, '[^\x20\x09-\x0D]') AS blank, string_split(t, '') AS c, length(t) AS n FROM t),
m AS (SELECT * EXCLUDE (c, n), CASE WHEN n > 1 THEN 100.0::DOUBLE * len(list_filter(list_zip(c[1:n - 1], c[2:n]), lambda x: x[1] <> x[2])) / (n - 1) ELSE 100 END AS complexity FROM d),
f AS (SELECT sha256, min(id) AS first FROM m WHERE NOT blank GROUP BY sha256)
SELECT id, lane, m.sha256, n_bytes, n_lines, blank, round(complexity, 6) AS complexity,
       CASE WHEN NOT blank AND id IS DISTINCT FROM first THEN first END AS reuse_of,
       CASE WHEN blank THEN 'blank' WHEN id IS DISTINCT FROM first THEN 'reused' WHEN complexity < 30 THEN 'low_complexity' ELSE 'accepted' END AS status
FROM m LEFT JOIN f ON m.sha256 = f.sha256
"""


if __name__ == "__main__":
    arguments = {"texts": "folder of the table of texts (Parquet files)", "out": "folder of the output", "checkpoint": "folder of the stream's checkpoint"}
    command_line("lane_intake", __doc__.split("\n")[0], CONFIG, arguments, lambda spark, given, config: run(spark, given.texts, given.out, given.checkpoint, config))
