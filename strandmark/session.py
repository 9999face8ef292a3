"""Session helpers shared by the queries, the bench and the tests."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def ensure_importable(spark: SparkSession) -> None:
    """Lets Python workers of this session import the package from where the driver found it."""
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *parts])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_session(cpus: int | str = 8, **conf: str) -> SparkSession:
    """A local session for the bench and the tests; a cluster brings its own configuration."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "1000")  # plans name their folders whole
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir). A local session without one gets a folder of its own; on a
    cluster that would be each machine's own disk, so there it must be set."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc._jsc.sc().getCheckpointDir().getOrElse(None)
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="strandmark-")
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A fresh path in the shared folder; removed when the application ends, unless it's to be kept."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if keep:
        return path
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df as a Parquet table in the shared folder: lineage ends here and lost executors cost nothing."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


#: Values (rows times columns) up to which Spark may broadcast a written table by the size of its files.
MOST_BROADCAST = 400_000


def by_rows(table: DataFrame) -> DataFrame:
    """A written table, with the hint to merge it in joins where it has many rows for their width. Spark goes by the size of the files, and few megabytes of
    packed positions are hundreds as the hashed rows of a broadcast, which the driver holds. Join a table with the hint to a small one by ``F.broadcast``."""
    if table.count() * len(table.columns) <= MOST_BROADCAST:  # rows from the files' footers
        return table
    hinted = table.hint("merge")
    hinted._written_to = getattr(table, "_written_to", None)
    return hinted


def discard(*tables: DataFrame) -> None:
    """Deletes what ``written`` has put down for these tables, once nothing that is still to run reads them."""
    for t in tables:
        if place := getattr(t, "_written_to", None):
            hadoop = t.sparkSession._jvm.org.apache.hadoop.fs.Path(place)
            hadoop.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(hadoop, True)
