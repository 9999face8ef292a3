"""Readers of the text formats: SAM, BED, VCF, interval tables, FASTQ, FASTA digests, samplesheets, JSON.

All go through Spark's readers, so any path Spark can open will do, plain or gzipped. Broken rows are found by joins and
filters and raised together with the first of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandmark.functions import reads as R
from strandmark.operators import intervals
from strandmark.sources import bam


def _refuse(bad: DataFrame, what: str) -> None:
    first = bad.limit(10).collect()
    if first:
        raise ValueError(f"{what}: {', '.join(str(tuple(r)) for r in first)}")


def sam(spark: SparkSession, path: str) -> DataFrame:
    """Aligned reads of SAM text (coordinate 1-based there). read_ord is the position in the file, by part and line."""
    lines = spark.read.text(path).where(~F.col("value").startswith("@") & (F.col("value") != "")).withColumn("read_ord", F.monotonically_increasing_id())
    f = F.split("value", "\t")
    nm = F.nullif(F.regexp_extract("value", r"\tNM:i:(\d+)", 1), F.lit("")).cast("int")
    rows = lines.select("read_ord", f[0].alias("query_name"), f[1].cast("int").alias("flag"), f[2].alias("contig"), (f[3].cast("long") - 1).alias("reference_start"), f[4].cast("int").alias("mapping_quality"), f[5].alias("cigar"), nm.alias("nm"))
    return rows.select("read_ord", "query_name", "flag", "contig", "reference_start", R.reference_end().alias("reference_end"), "mapping_quality", "cigar", "nm")


def store_reads(reads: DataFrame, path: str) -> None:
    """Reads as Parquet, a folder a contig, each file a range of places in order: what looks for a region skips the rest by the
    folders' names and the files' bounds."""
    ranged = reads.repartitionByRange("contig", "reference_start").sortWithinPartitions("contig", "reference_start", "read_ord")
    ranged.write.partitionBy("contig").parquet(path)


def region(reads: DataFrame, contig: str, start: int, end: int) -> DataFrame:
    """The reads that overlap [start, end) of a contig, by conditions that reach the files."""
    return reads.where((F.col("contig") == contig) & (F.col("reference_start") < end) & (F.col("reference_end") > start))


def sam_contigs(spark: SparkSession, path: str) -> DataFrame:
    """(contig, length, ordinal) of the @SQ header lines."""
    head = spark.read.text(path).where(F.col("value").startswith("@SQ")).withColumn("ordinal", F.monotonically_increasing_id())
    return head.select(F.regexp_extract("value", r"\tSN:([^\t]+)", 1).alias("contig"), F.regexp_extract("value", r"\tLN:(\d+)", 1).cast("long").alias("length"), "ordinal")


def bed(spark: SparkSession, path: str, contigs: DataFrame) -> DataFrame:
    """The interval mask of a BED file: (contig, start, end). Comments, track and browser lines are skipped."""
    v = F.trim("value")
    rows = spark.read.text(path).where((v != "") & ~v.rlike(r"^(#|track\s|browser\s)"))
    f = F.split(v, r"\s+")
    parsed = rows.select("value", F.get(f, F.lit(0)).alias("contig"), F.get(f, F.lit(1)).try_cast("long").alias("start"), F.get(f, F.lit(2)).try_cast("long").alias("end"))
    parsed = parsed.join(contigs.select("contig", "length"), "contig", "left")
    wrong = F.col("start").isNull() | F.col("end").isNull() | (F.col("start") < 0) | (F.col("start") >= F.col("end")) | F.col("length").isNull() | (F.col("end") > F.col("length"))
    _refuse(parsed.where(wrong).select("value"), "mask rows")
    kept = parsed.select("contig", "start", "end")
    if kept.isEmpty():
        raise ValueError("the mask has no intervals")
    return kept


def vcf(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(variants(contig, pos, ref, alts, end), header contigs(contig, length)); end: the last base, 1-based, of INFO/END."""
    lines = spark.read.text(path)
    head = lines.where(F.col("value").startswith("##contig"))
    declared = head.select(F.regexp_extract("value", r"ID=([^,>]+)", 1).alias("contig"), F.nullif(F.regexp_extract("value", r"length=(\d+)", 1), F.lit("")).cast("long").alias("length"))
    f = F.split("value", "\t")
    rows = lines.where(~F.col("value").startswith("#") & (F.col("value") != ""))
    end = F.nullif(F.regexp_extract(F.coalesce(F.get(f, F.lit(7)), F.lit("")), r"(?:^|;)END=(\d+)", 1), F.lit("")).cast("long")
    return rows.select(f[0].alias("contig"), f[1].cast("long").alias("pos"), f[3].alias("ref"), F.filter(F.split(f[4], ","), lambda a: a != ".").alias("alts"), end.alias("end")), declared


def check_contigs(used: DataFrame, declared: DataFrame, what: str) -> None:
    """Every used contig(contig, length) must be declared, with the same length where one is given."""
    _refuse(used.join(declared, "contig", "left_anti").select("contig").orderBy("contig"), f"{what} lacks contigs")
    both = used.select("contig", F.col("length").alias("a")).join(declared.select("contig", F.col("length").alias("b")), "contig")
    _refuse(both.where("a <> b"), f"{what} has other lengths")


def same_contigs(a: DataFrame, b: DataFrame) -> None:
    """Names, lengths and order must agree."""
    w = lambda df, n: df.select("contig", "length", "ordinal").orderBy("ordinal").collect()  # noqa: E731  a row a contig
    if [(r[0], r[1]) for r in w(a, "a")] != [(r[0], r[1]) for r in w(b, "b")]:
        raise ValueError("treated and control reads have different contigs")


INTERVAL_COLUMNS = ["contig", "owner_start", "owner_end", "scan_start", "scan_end"]


def interval_table(spark: SparkSession, path: str, contigs: DataFrame | None = None) -> DataFrame:
    """Owned and scanned intervals of a tab-separated table; owned ones may not overlap."""
    raw = spark.read.option("sep", "\t").option("header", True).csv(path)
    if missing := [c for c in INTERVAL_COLUMNS if c not in raw.columns]:
        raise ValueError(f"interval table lacks {missing}")
    rows = raw.select("contig", *[F.col(c).try_cast("long").alias(c) for c in INTERVAL_COLUMNS[1:]])
    good = (F.col("scan_start") >= 0) & (F.col("scan_start") <= F.col("owner_start")) & (F.col("owner_start") < F.col("owner_end")) & (F.col("owner_end") <= F.col("scan_end"))
    _refuse(rows.where(~F.coalesce(good, F.lit(False))), "intervals")
    own = rows.select("contig", F.col("owner_start").alias("start"), F.col("owner_end").alias("end"))
    tiles = own.join(own.groupBy("contig").agg(F.max("end").alias("length")), "contig")
    _refuse(intervals.coverage_faults(own, tiles.select("contig", "length").distinct()).where("fault = 'overlap'"), "overlapping intervals")
    if contigs is not None:
        _refuse(rows.join(contigs.select("contig", "length"), "contig", "left").where("length IS NULL OR scan_end > length"), "intervals outside the contigs")
    return rows


def owned(points: DataFrame, table: DataFrame, pos: str = "pos") -> DataFrame:
    """The points inside some owned interval."""
    return intervals.at_positions(points, table.select("contig", F.col("owner_start").alias("start"), F.col("owner_end").alias("end")), pos, "left_semi")


def fastq(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(name, seq, qual) of one or more lanes. Files may be read in many splits: lines are numbered by what splits hold, a row a
    split, and a record's four lines meet by their number, wherever they lie."""
    text = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    splits = text.groupBy("_file", "_block").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # of splits, not of lines
    placed = splits.select("_file", "_block", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    rows = text.join(placed, ["_file", "_block"]).withColumn("_line", F.col("_at") + F.col("_shift"))
    rows = rows.select("_file", F.floor(F.col("_line") / 4).alias("_record"), (F.col("_line") % 4).cast("int").alias("_k"), "value")
    part = lambda k: F.max(F.when(F.col("_k") == k, F.col("value")))
    return rows.groupBy("_file", "_record").agg(F.substr(part(0), F.lit(2)).alias("name"), part(1).alias("seq"), part(3).alias("qual")).drop("_file", "_record")


def _tails(seqs: list[str], base: str, least: int) -> np.ndarray:
    """Of each sequence, the bases of the tail that is all ``base`` but for one in eight, five at most; 0 if shorter than ``least``."""
    sizes = np.fromiter(map(len, seqs), np.int64, len(seqs))
    width = int(sizes.max(initial=0))
    if not width:
        return np.zeros(len(seqs), np.int64)
    # from the end on, padded with what is neither
    letters = np.frombuffer("".join(s[::-1].ljust(width, "\0") for s in seqs).encode("utf-32-le"), np.uint32).reshape(len(seqs), width)
    own = letters == ord(base)
    place = np.arange(width)
    other = np.cumsum(~own, axis=1)
    over = (other > 5) | (other > (place + 1) // 8) & (place >= least - 1) | (place >= sizes[:, None])
    stop = np.where(over.any(1), over.argmax(1), width)
    last = np.where(own & (place < stop[:, None]), place + 1, 0).max(1)
    return np.where(stop >= least, last, 0)


def trimmed_tails(reads: DataFrame, least: int = 10, bases: str = "GATC") -> DataFrame:
    """reads without their polyG/polyX tails: the longest tail of one base, of seq and qual alike. ``G`` alone: polyG.

    Tails are found in Arrow batches, once a read: as an expression of four walks over the letters the optimiser would spell them out at each use.
    """

    @F.pandas_udf("long")
    def tail(seq: pd.Series) -> pd.Series:
        out = np.zeros(len(seq), np.int64)
        texts = seq.fillna("").tolist()
        first = 0
        while first < len(texts):
            # some four million letters at once, as wide as the longest
            last, widest = first, 0
            while last < len(texts) and (last == first or max(widest, len(texts[last])) * (last + 1 - first) <= 1 << 22):
                widest = max(widest, len(texts[last]))
                last += 1
            out[first:last] = np.max([_tails(texts[first:last], b, least) for b in bases], axis=0)
            first = last
        return pd.Series(out)

    # not deterministic, so that the optimiser neither moves nor repeats it
    cut = reads.withColumn("_left", F.length("seq") - tail.asNondeterministic()("seq"))
    return cut.withColumns({c: F.substring(F.col(c), F.lit(1), F.col("_left")) for c in ("seq", "qual")}).drop("_left")


def passing_reads(reads: DataFrame, phred: int = 20, length: int = 30, low_complexity: int | None = 30, max_low: float = 0.4) -> DataFrame:
    """PolyG/polyX tails trimmed, then length, base quality and complexity filters as column expressions. Complexity:
    share of bases unlike the next."""
    reads = trimmed_tails(reads)
    low: Column = F.size(F.filter(F.split("qual", ""), lambda q: F.ascii(q) - 33 < phred)) / F.greatest(F.length("qual"), F.lit(1))
    keep = (F.length("seq") >= length) & (low <= max_low)
    if low_complexity is not None:
        letters = F.split("seq", "")
        changes = F.size(F.filter(F.zip_with(F.slice(letters, 1, F.greatest(F.size(letters) - 1, F.lit(0))), F.slice(letters, 2, F.greatest(F.size(letters) - 1, F.lit(0))), lambda a, b: a != b), lambda x: x))
        keep = keep & (100 * changes / F.greatest(F.length("seq") - 1, F.lit(1)) >= low_complexity)
    return reads.where(keep)


def digests(spark: SparkSession, paths: list[str], block_bytes: int = 8 << 20) -> DataFrame:
    """(path, size, sha256) of files' bytes, for provenance, a row a file.

    A file is read block by block where its row is, through Arrow's file systems, so it may be of any size: Spark's ``binaryFile`` takes a
    file into a row and refuses those over 2 GB, as a genome's sequence is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                digest, at = hashlib.sha256(), 0
                with bam.opened(path) as file:
                    while block := file.read_at(block_bytes, at):
                        digest.update(block)
                        at += len(block)
                yield pa.RecordBatch.from_pydict({"path": [path], "size": [at], "sha256": [digest.hexdigest()]})

    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))
    return files.mapInArrow(run, "path string, size long, sha256 string")


def sha256(spark: SparkSession, path: str) -> str:
    """Of one file."""
    return digests(spark, [path]).first().sha256


def fragments(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Row fragments of JSON lines, gzipped or not."""
    return spark.read.schema(schema).json(path) if schema else spark.read.json(path)


def summaries(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document a file."""
    return spark.read.option("multiLine", True).json(path)


def unique_calls(calls: DataFrame) -> DataFrame:
    """calls; raises where (contig, position, strand) repeats."""
    _refuse(calls.groupBy("contig", "position_0based", "strand").count().where("count > 1"), "repeated calls")
    return calls
