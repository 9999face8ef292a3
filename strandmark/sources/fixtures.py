"""The driver's tables as reads, variants and a mask: one SQL text for both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmark.session import new_folder, table

READS_SQL = """
SELECT sample, read_ord, query_name, flag, contig, reference_start, reference_end, mapping_quality, cigar, nm FROM (
 SELECT *, reference_start * 100000000 + ord AS read_ord FROM (
  SELECT sample, contig, mapping_quality, nm, query_name, ord, span,
   CASE WHEN rev THEN anchor + jit - pm4 - split + 1 - span ELSE anchor - jit + split END AS reference_start,
   CASE WHEN rev THEN anchor + jit - pm4 - split + 1 ELSE anchor - jit + split + span END AS reference_end,
   CAST((CASE WHEN d = 10 THEN 1024 ELSE 0 END) + (CASE WHEN t = 8 THEN 256 ELSE 0 END) + (CASE WHEN t = 7 AND d = 9 THEN 2048 ELSE 0 END) + (CASE WHEN rev THEN 16 ELSE 0 END) AS INT) AS flag,
   CASE WHEN t = 3 AND pm4 = 1 THEN (CASE WHEN rev THEN CONCAT(CAST(span AS VARCHAR(9)), 'M5S') ELSE CONCAT('5S', CAST(span AS VARCHAR(9)), 'M') END)
        WHEN t IN (4, 5) AND pm7 = 0 THEN CONCAT('5M1I', CAST(span - 5 AS VARCHAR(9)), 'M')
        WHEN t = 6 AND pm7 = 0 THEN CONCAT('5M3D', CAST(span - 8 AS VARCHAR(9)), 'M')
        ELSE CONCAT(CAST(span AS VARCHAR(9)), 'M') END AS cigar
  FROM (
   SELECT *, CASE WHEN sample = 'control' AND pm5 <> 0 THEN jit0 WHEN om3 = 0 THEN jit0 ELSE 0 END AS jit,
    CAST(CASE WHEN line = 7 THEN NULL WHEN t = 5 THEN 1 WHEN t = 6 THEN 3 ELSE d % 2 END AS INT) AS nm
   FROM (
    SELECT CASE WHEN l_linestatus = 'O' OR l_returnflag = 'R' THEN 'treated' ELSE 'control' END AS sample,
     CONCAT('chr', CAST(l_partkey % 3 + 1 AS VARCHAR(9))) AS contig, l_linenumber % 2 = 0 AS rev, l_linenumber AS line,
     40 + CAST(l_quantity AS INT) % 21 AS span, l_partkey * 40 + 200 AS anchor,
     (l_orderkey * 31 + l_linenumber * 7 + CAST(l_quantity AS INT)) % 40 AS jit0,
     CASE WHEN l_partkey % 6 = 0 THEN l_orderkey % 2 ELSE 0 END AS split,
     CAST(round(l_tax * 100) AS INT) AS t, CAST(round(l_discount * 100) AS INT) AS d,
     CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 61 AS INT) AS mapping_quality,
     l_partkey % 4 AS pm4, l_partkey % 5 AS pm5, l_partkey % 7 AS pm7, l_orderkey % 3 AS om3,
     l_orderkey * 10 + l_linenumber AS ord,
     CONCAT(CAST(l_orderkey AS VARCHAR(20)), '/', CAST(l_linenumber AS VARCHAR(9)), '/', CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR(20))) AS query_name
    FROM lineitem) a) b) c) e
"""
VARIANTS_SQL = """
SELECT CONCAT('chr', CAST(p_partkey % 3 + 1 AS VARCHAR(9))) AS contig, p_partkey * 40 + 204 AS pos, CASE WHEN p_partkey % 11 = 0 THEN 'AA' ELSE 'A' END AS ref,
 CASE WHEN p_partkey % 22 = 0 THEN 'A,AAT' WHEN p_partkey % 11 = 0 THEN 'A' ELSE 'G' END AS alt
FROM part WHERE p_partkey % 11 = 0 OR p_partkey % 13 = 0
"""
MASK_SQL = """
SELECT CONCAT('chr', CAST(p_partkey % 3 + 1 AS VARCHAR(9))) AS contig, p_partkey * 40 + 195 AS start_, p_partkey * 40 + 205 AS end_ FROM part WHERE p_partkey % 9 = 0
UNION ALL
SELECT CONCAT('chr', CAST(p_partkey % 3 + 1 AS VARCHAR(9))), p_partkey * 40 + 205, p_partkey * 40 + 210 FROM part WHERE p_partkey % 9 = 0
"""
#: Templates: the first two lines of an order are mates, other lines single reads; places are few, so that fragments repeat.
PAIRS_SQL = """
SELECT o * 10 + line AS read_ord, CASE WHEN n > 1 AND line < 3 THEN CONCAT('p', CAST(o AS VARCHAR(20))) ELSE CONCAT('s', CAST(o AS VARCHAR(20)), '/', CAST(line AS VARCHAR(9))) END AS query_name,
 CAST((CASE WHEN n > 1 AND line < 3 THEN (CASE WHEN line = 1 THEN 65 ELSE 129 END) ELSE 0 END) + (CASE WHEN rev THEN 16 ELSE 0 END) AS INT) AS flag,
 CONCAT('chr', CAST(o % 3 + 1 AS VARCHAR(9))) AS contig, place + head AS reference_start, place + head + 50 AS reference_end, mapping_quality,
 CONCAT(CASE head WHEN 8 THEN '5H3S' WHEN 5 THEN '5S' ELSE '' END, '50M', CASE tail WHEN 7 THEN '4S3H' WHEN 2 THEN '2H' ELSE '' END) AS cigar, CAST(NULL AS INT) AS nm, head, tail
FROM (SELECT l_orderkey AS o, line, count(*) OVER (PARTITION BY l_orderkey) AS n, line % 2 = 0 AS rev,
  (l_orderkey * 7 + line * 3) % 40 * 500 + (CASE WHEN line = 2 THEN 300 ELSE 0 END) AS place, CASE l_orderkey % 4 WHEN 0 THEN 8 WHEN 1 THEN 5 ELSE 0 END AS head,
  CASE l_orderkey % 3 WHEN 0 THEN 7 WHEN 1 THEN 2 ELSE 0 END AS tail, CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 61 AS INT) AS mapping_quality
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate) AS line FROM lineitem) x) a
"""
CONTIGS_SQL = "SELECT contig, length FROM (SELECT CAST((max(p_partkey) + 1) * 40 + 1000 AS BIGINT) AS length FROM part) l CROSS JOIN (SELECT 'chr1' AS contig UNION ALL SELECT 'chr2' UNION ALL SELECT 'chr3') c"


def _sql(spark: SparkSession, sf_dir: str, text: str, name: str) -> DataFrame:
    return spark.sql(text.replace(f"FROM {name}", "FROM {t}"), t=table(spark, sf_dir, name))


_WRITTEN: dict[tuple[str, str], str] = {}


def reads(spark: SparkSession, sf_dir: str, sample: str = "treated") -> DataFrame:
    """Aligned reads of a sample. The projection is nested deeply, and Catalyst would spell it out in each scan, so it's
    written once an application and folder, partitioned by sample, as reads are kept in practice."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN:
        path = new_folder(spark, "reads")
        setting = "spark.sql.maxConcurrentOutputFileWriters"
        before = spark.conf.get(setting)
        spark.conf.set(setting, "2")  # of two samples a task keeps both files open, and needn't sort its rows by them
        try:
            _sql(spark, sf_dir, READS_SQL, "lineitem").write.partitionBy("sample").parquet(path)
        finally:
            spark.conf.set(setting, before)
        _WRITTEN[key] = path
    return spark.read.parquet(_WRITTEN[key]).where(F.col("sample") == sample).drop("sample")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned reads, single ones and mates of pairs."""
    return _sql(spark, sf_dir, PAIRS_SQL, "lineitem").drop("head", "tail")


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, VARIANTS_SQL, "part").select("contig", "pos", "ref", F.split("alt", ",").alias("alts"))


def mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, MASK_SQL, "part").withColumnsRenamed({"start_": "start", "end_": "end"})


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, CONTIGS_SQL, "part")
