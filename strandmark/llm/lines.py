"""Operator 2 [native]: line dedup by range-partitioned hashes; decisions travel as bitmaps, never as text.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lower-cased. Lines become
(h1, h2, id, t, pos): two chained 64-bit hashes of the key, so keys are told apart by 128 bits, and a hash of the text,
which tells rows that share an id apart. These rows are range-partitioned by (h1, h2, id) and sorted by position behind
them, which splits a hash that a third of all documents hold over many ranges. In that order the first line of each (key,
document) is streamed out; counts of documents and first occurrences are pre-aggregated in each range before one row
a key and range is exchanged. Decisions return as keep bitmaps, a bit a line, set where it stays, in words of 64; they're
compressed by leaving out the words, and the documents, that keep all.

Three policies: ``every`` (keys in at least ``min_docs`` documents lose all their lines), ``repeats`` (of such keys,
the first occurrence by document and position stays) and ``boilerplate``: the first occurrence stays, but for keys that
at least ``min_docs`` documents of mostly other text hold (``OWN_SHARE`` of the keys' characters being of keys that are
not common); those lose all their lines. So the lines of copies, exact or near, however many, stay in one document.

Edge cases: null and empty texts are one empty line; keys shorter than ``min_chars`` code points (blank lines at the
default of 1) are never dropped; a document that loses every line keeps the empty text; rows
that share an id count as one document and are cut each by its own lines; rows with a null id are never counted nor
cut; columns of the input may have any names, also those used inside; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import base

BLANKS = " \t\n\x0b\x0c\r"
#: The share of a document's characters in uncommon lines from which its common lines are additions to a text of its own.
OWN_SHARE = 0.75
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """lower() takes the place of translate() where it's equal and faster: in lines of ASCII only."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int, sizes: bool = False) -> DataFrame:
    """(id, t, pos, h1, h2[, size]) of each line whose key is long enough, written to the shared folder; t: the text's hash."""
    lines = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.hash(text_col).alias("t"), F.posexplode(split_lines(F.col(text_col))).alias("pos", "line"))
    keys = lines.select("id", "t", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    size = [F.char_length("key").alias("size")] if sizes else []
    return base.written(keys.select("id", "t", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), *size), "lines")


def spread_keys(hashes: DataFrame, hit: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2) of the common keys, whose lines are ``hit``, that enough documents of mostly other text hold."""
    whole = hashes.groupBy("id").agg(F.sum("size").alias("whole"))
    common = hit.groupBy("id").agg(F.sum("size").alias("common"))
    own = common.join(whole, "id").where(F.col("whole") - F.col("common") >= OWN_SHARE * F.col("whole")).select("id")
    return hit.join(own.hint("shuffle_hash"), "id", "left_semi").select("h1", "h2", "id").distinct().groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("h1", "h2")


def keep_bitmaps(docs: DataFrame, min_docs: int, min_chars: int = 1, policy: str = "every", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, t, words map<int,long>, n_dropped) of each row that loses lines; a word that isn't there keeps all of its 64 lines."""
    if policy not in ("every", "repeats", "boilerplate"):
        raise ValueError(f"policy {policy!r}")
    hashes = line_hashes(docs, id_col, text_col, min_chars, policy == "boilerplate")
    ranged = hashes.repartitionByRange(base.partitions_for(docs.sparkSession), "h1", "h2", "id").sortWithinPartitions("h1", "h2", "id", "t", "pos")
    within = Window.partitionBy("h1", "h2", "id").orderBy("t", "pos")
    firsts = ranged.withColumn("k", F.row_number().over(within)).where("k = 1")
    keys = firsts.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.min(F.struct("id", "t", "pos")).alias("first"))
    # a table of its own, so that both sides of the join are plain exchanges, of which Spark splits the hot parts
    common = base.written(keys.where(F.col("n_docs") >= min_docs).select("h1", "h2", "first"), "common-lines")
    hit = hashes.join(common, ["h1", "h2"])
    if policy == "repeats":
        hit = hit.where(F.struct("id", "t", "pos") != F.col("first"))
    if policy == "boilerplate":
        hit = base.written(hit.withColumn("first", F.struct("id", "t", "pos") == F.col("first")), "common-places")
        # a row a key: of the many places of a key only the first is looked up
        stay = hit.where("first").join(spread_keys(hashes, hit, min_docs), ["h1", "h2"], "left_anti")
        hit = hit.where("NOT first").select("id", "t", "pos").union(hit.where("first").select("id", "t", "pos").join(stay.select("id", "t", "pos"), ["id", "t", "pos"], "left_anti"))
    word = hit.groupBy("id", "t", F.expr("pos div 64").cast("int").alias("word")).agg(F.expr("~bit_or(shiftleft(1L, pos % 64))").alias("bits"))
    return word.groupBy("id", "t").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("words"),
        F.sum(64 - F.bit_count("bits")).cast("long").alias("n_dropped"),
    )


def dedup_lines(docs: DataFrame, min_docs: int, min_chars: int = 1, policy: str = "every", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with ``text_col`` cut, and ``n_lines`` (before) and ``n_dropped`` (replaced, if there are such columns)."""
    maps = keep_bitmaps(docs, min_docs, min_chars, policy, id_col, text_col)
    maps = maps.select(F.struct("id", "t").alias("_map_key"), F.struct("words", "n_dropped").alias("_map"))
    rest = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    own = (F.col(id_col) == F.col("_map_key.id")) & (F.hash(text_col) == F.col("_map_key.t"))
    joined = docs.join(maps.hint("shuffle_hash"), own, "left")
    lines = split_lines(F.col(text_col))
    bits = lambda i: F.coalesce(F.try_element_at(F.col("_map.words"), F.floor(i / 64).cast("int")), F.lit(-1).cast("long"))
    stays = lambda i: F.getbit(bits(i), (i % 64).cast("int")) == 1
    kept = F.when(F.col("_map").isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(F.array_join(F.filter(lines, lambda x, i: stays(i)), "\n"))
    return joined.select(
        *[kept.alias(c) if c == text_col else F.col(f"`{c}`") for c in rest],
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.col("_map.n_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    cut = dedup_lines(docs, min_docs=10)
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


#: The cut documents of table {docs} (doc_id, text).
KEPT_SQL = """
lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM {docs}),
keyed AS (SELECT *, translate(trim(line, concat(chr(32), chr(9), chr(10), chr(11), chr(12), chr(13))),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT doc_id, pos, line, common.key IS NOT NULL AS gone FROM keyed LEFT JOIN common ON keyed.key = common.key),
kept AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
                coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
         FROM marked GROUP BY doc_id)
"""
SQL = f"WITH {KEPT_SQL.format(docs='documents')} SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM kept"
