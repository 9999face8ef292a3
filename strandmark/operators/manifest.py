"""Samplesheets: every fault is found and reported together, then rows are normalised."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

REQUIRED = ["sample", "fastq_1", "fastq_2"]
OPTIONAL = ["lane", "control", "variant_vcf"]
NAME, FASTQ, VCF = r"^[A-Za-z0-9_.-]+$", r"(?i)\.(fastq|fq)\.gz$", r"(?i)\.vcf\.gz$"
#: Of the written sheet; ``layout`` is for later steps.
WRITTEN = ["sample", "lane", "fastq_1", "fastq_2", "control", "variant_vcf", "variant_index", "is_control"]
COLUMNS = [*WRITTEN, "layout"]


def read(spark: SparkSession, path: str) -> DataFrame:
    """Rows with a line number; the header must name known columns once. ``lane`` is null throughout if there's no such column."""
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    names = [c.strip() for c in raw.columns]
    if len(set(names)) < len(names):
        raise ValueError("duplicate columns")
    if unknown := sorted(set(names) - {*REQUIRED, *OPTIONAL}):
        raise ValueError(f"unknown columns: {unknown}")
    if missing := [c for c in REQUIRED if c not in names]:
        raise ValueError(f"missing columns: {missing}")
    rows = raw.toDF(*names)
    text = lambda c: F.trim(F.coalesce(c, F.lit(""))) if c in names else F.lit(None if c == "lane" else "").cast("string")
    clean = rows.select(*[text(c).alias(c) for c in [*REQUIRED, *OPTIONAL]])
    return clean.withColumn("line", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())) + 1)  # a row a lane


def resolved(path: str) -> str:
    """A local path without links and detours; others as they are."""
    return path if "://" in path else os.path.realpath(os.path.expanduser(path))


def normalised(rows: DataFrame, analysis: str, exists: Callable[[str], bool] | None = None, resolve: Callable[[str], str] = resolved) -> DataFrame:
    """The checked rows in order: controls first. ``exists`` tells whether an input file is there; paths are compared and
    returned as ``resolve`` has them.

    Rows without a lane (null) are numbered; a blank one is a fault. Raises ValueError with every fault, by line.
    """
    if analysis not in ("digenome", "ndigenome"):
        raise ValueError(f"unknown analysis {analysis!r}")
    given = rows.orderBy("line").collect()  # a row a lane
    if not given:
        raise ValueError("the samplesheet has no rows")
    spark = rows.sparkSession
    paths = sorted({r[c] for r in given for c in ("fastq_1", "fastq_2", "variant_vcf") if r[c]})
    index = {p: next((resolve(p) + e for e in (".tbi", ".csi") if exists(p + e)), "") if exists else "" for p in sorted({r["variant_vcf"] for r in given if r["variant_vcf"]})}
    known = spark.createDataFrame([(p, resolve(p), index.get(p, "")) for p in paths] or [("", "", "")], "path string, real string, index string")
    for c in ("fastq_1", "fastq_2", "variant_vcf"):
        rows = rows.join(F.broadcast(known.select(F.col("path").alias(c), F.col("real").alias(f"{c}_real"), *([F.col("index").alias("variant_index")] if c == "variant_vcf" else []))), c, "left")
    rows = rows.fillna("", ["fastq_1_real", "fastq_2_real", "variant_vcf_real", "variant_index"])
    by_sample = Window.partitionBy("sample")
    auto = F.concat(F.lit("L"), F.lpad(F.row_number().over(by_sample.orderBy("line")).cast("string"), 3, "0"))
    rows = rows.withColumn("lane", F.coalesce("lane", auto)).withColumn("layout", F.when(F.col("fastq_2") == "", "SE").otherwise("PE"))
    wide = rows.withColumns(
        {
            "_lanes": F.count("*").over(Window.partitionBy("sample", "lane")),
            "_layouts": F.size(F.collect_set("layout").over(by_sample)),
            "_controls": F.size(F.collect_set("control").over(by_sample)),
            "_vcfs": F.size(F.collect_set("variant_vcf_real").over(by_sample)),
        }
    )
    faults = [
        (F.col("sample") == "", "blank sample"),
        ((F.col("sample") != "") & ~F.col("sample").rlike(NAME), "sample has other characters than letters, digits, _ . -"),
        ((F.col("control") != "") & ~F.col("control").rlike(NAME), "control has other characters than letters, digits, _ . -"),
        (F.col("lane") == "", "blank lane; name every lane or leave out the column"),
        (F.col("fastq_1") == "", "blank fastq_1"),
        ((F.col("fastq_1") != "") & ~F.col("fastq_1").rlike(FASTQ), "fastq_1 isn't .fastq.gz or .fq.gz"),
        ((F.col("fastq_2") != "") & ~F.col("fastq_2").rlike(FASTQ), "fastq_2 isn't .fastq.gz or .fq.gz"),
        ((F.col("variant_vcf") != "") & ~F.col("variant_vcf").rlike(VCF), "variant_vcf isn't .vcf.gz"),
        ((F.col("_lanes") > 1) & (F.col("lane") != ""), "sample and lane repeat"),
        (F.col("_layouts") > 1, "single and paired lanes in a sample"),
        (F.col("_controls") > 1, "lanes of a sample name different controls"),
        (F.col("_vcfs") > 1, "lanes of a sample name different variants"),
        ((F.col("control") == F.col("sample")) & (F.col("sample") != ""), "a sample is its own control"),
    ]
    if analysis == "ndigenome":
        faults.append((F.col("layout") == "SE", "ndigenome needs paired reads"))
    found = wide.select("line", F.explode(F.array_compact(F.array(*[F.when(t, F.lit(m)) for t, m in faults]))).alias("message"))
    files = rows.select("line", "sample", F.explode(F.array("fastq_1_real", "fastq_2_real")).alias("path")).where("path <> ''")
    reused = files.groupBy("path").agg(F.max("line").alias("line"), F.count("*").alias("n")).where("n > 1").select("line", F.concat(F.lit("file used twice: "), "path").alias("message"))
    # lanes of a sample are put side by side, so their files' names must differ
    names = files.select("line", "sample", "path", F.element_at(F.split("path", "/"), -1).alias("name")).groupBy("sample", "name").agg(F.max("line").alias("line"), F.count_distinct("path").alias("n"))
    clash = names.where("n > 1").select("line", F.concat(F.lit("files of one name: "), "name").alias("message"))
    samples = rows.groupBy("sample").agg(F.max("control").alias("its"))
    lost = rows.where("control <> ''").join(samples.select(F.col("sample").alias("control")), "control", "left_anti").select("line", F.concat(F.lit("no such control: "), "control").alias("message"))
    chain = rows.where("control <> '' AND control <> sample").join(samples.select(F.col("sample").alias("control"), "its"), "control").where("its <> ''").select("line", F.concat(F.lit("the control has a control: "), "control").alias("message"))
    errors = found.union(reused).union(clash).union(lost).union(chain)
    messages = [f"line {r['line']}: {r['message']}" for r in errors.distinct().orderBy("line", "message").collect()]
    if exists is not None:
        for r in given:
            messages += [f"line {r['line']}: no such file: {r[c]}" for c in ("fastq_1", "fastq_2", "variant_vcf") if r[c] and not exists(r[c])]
            if r["variant_vcf"] and exists(r["variant_vcf"]) and not index[r["variant_vcf"]]:
                messages.append(f"line {r['line']}: no index of {r['variant_vcf']}")
    if messages:
        raise ValueError("\n".join(messages))
    controls = rows.where("control <> ''").select(F.col("control").alias("sample")).distinct().withColumn("_c", F.lit(True))
    out = rows.join(controls, "sample", "left").withColumn("is_control", F.when(F.col("_c"), "true").otherwise("false"))
    out = out.drop("fastq_1", "fastq_2", "variant_vcf").withColumnsRenamed({"fastq_1_real": "fastq_1", "fastq_2_real": "fastq_2", "variant_vcf_real": "variant_vcf"})
    return out.orderBy(F.col("is_control").desc(), "sample", "lane", "fastq_1", "fastq_2").select(*COLUMNS)


def write(rows: DataFrame, folder: str) -> None:
    """The normalised sheet as one CSV file, in its order."""
    rows.select(*WRITTEN).coalesce(1).sortWithinPartitions(F.col("is_control").desc(), "sample", "lane", "fastq_1", "fastq_2").write.option("header", True).option("emptyValue", "").csv(folder)


def matched(rows: DataFrame) -> DataFrame:
    """Treated samples with their control's name (null without one); controls themselves aren't called."""
    one = rows.select("sample", "control", "is_control").distinct()
    return one.where("is_control = 'false'").select("sample", F.nullif(F.col("control"), F.lit("")).alias("control_sample"))
