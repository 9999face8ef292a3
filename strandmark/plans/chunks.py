"""Calls by chunk: row fragments and a summary document a chunk, and their checked union.

A cluster needs none of this, the call is one plan; it is for runs that an external scheduler cuts into pieces. A piece may be cut out of a whole
call (``write_chunks``) or called by itself, from the reads near it (``local_chunks``, ``write_chunk``). Fragments hold
call rows before q values and filters, since both are of the whole sample.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strandmark.functions.statistics import benjamini_hochberg
from strandmark.operators import evidence, intervals
from strandmark.operators.runinfo import json_safe
from strandmark.plans import calling
from strandmark.schema import Params
from strandmark.session import by_rows, written
from strandmark.sources import formats

OWNED = "chunk_id string, contig string, start long, `end` long"


def _owned(plan: list[dict]) -> list[tuple]:
    return [(r["chunk_id"], r["contig"], r["owner_start"], r["owner_end"]) for r in plan]


def write_chunks(found: DataFrame, candidates: DataFrame, plan: list[dict], contigs: DataFrame, params: Params, folder: str) -> None:
    """``rows`` (gzipped JSON lines, a folder a chunk) and ``summaries`` (a line of JSON a chunk) of calling.rows and a
    planner.plan. Rows outside all chunks are a fault. For chunks that are called by themselves, see local_chunks."""
    spark = found.sparkSession
    own = F.broadcast(spark.createDataFrame(_owned(plan), OWNED))  # of the plan, so few
    slim = by_rows(written(found.drop("control_fisher_q"), "rows"))
    of_chunk = by_rows(written(intervals.at_positions(slim, own).drop("start", "end").withColumn("_chunk_id", F.col("chunk_id")), "chunk-rows"))
    formats._refuse(slim.join(of_chunk.select("contig", "pos", "strand"), ["contig", "pos", "strand"], "left_anti").select("contig", "pos", "strand"), "rows outside all chunks")
    of_chunk.write.partitionBy("chunk_id").option("compression", "gzip").option("ignoreNullFields", False).json(f"{folder}/rows")
    reported = {r["chunk_id"]: r["count"] for r in of_chunk.groupBy("chunk_id").count().collect()}
    seen = {r["chunk_id"]: r["count"] for r in intervals.at_positions(calling.position(candidates), own).groupBy("chunk_id").count().collect()}
    lengths, used = _lengths(contigs), {r["contig"] for r in plan}
    documents = []
    for chunk in dict.fromkeys(r["chunk_id"] for r in plan):
        pieces = [(r["contig"], r["owner_start"], r["owner_end"]) for r in plan if r["chunk_id"] == chunk]
        documents.append((_document(chunk, pieces, params, {c: n for c, n in lengths.items() if c in used}, reported.get(chunk, 0), seen.get(chunk, 0), of_chunk.drop("chunk_id").schema),))
    spark.createDataFrame(documents, "value string").coalesce(1).write.text(f"{folder}/summaries")


def _lengths(contigs: DataFrame) -> dict[str, int]:
    """By contig, in their order."""
    return {r["contig"]: r["length"] for r in contigs.orderBy("ordinal" if "ordinal" in contigs.columns else "contig").collect()}


def _document(chunk: str, pieces: list[tuple[str, int, int]], params: Params, lengths: dict[str, int], reported: int, candidates: int, schema: StructType) -> str:
    """A chunk's summary: what it owns of which contigs, its counts, the schema of its rows."""
    document = {
        "schema_version": 1,
        "sample": params.sample,
        "analysis": params.analysis,
        "chunk_id": chunk,
        "parameters": vars(params),
        "expected_contigs": list(lengths),
        "expected_contig_lengths": lengths,
        "contigs": list(dict.fromkeys(c for c, _, _ in pieces)),
        "intervals": [{"contig": c, "start": a, "end": b} for c, a, b in pieces],
        "reported_rows": reported,
        "candidate_count": candidates,
        "row_schema": schema.jsonValue(),
    }
    return json.dumps(json_safe(document), sort_keys=True)


def write_chunk(chunk: str, candidates: DataFrame, found: DataFrame, pieces: list[tuple[str, int, int]], params: Params, lengths: dict[str, int], folder: str) -> int:
    """Rows and summary of one chunk that was called by itself (local_chunks.call), in the form that ``finalised`` reads; rows written. Both
    replace what an earlier run of the chunk has left. lengths: of all contigs that the chunks of the run share."""
    rows = written(found.drop("control_fisher_q").withColumn("_chunk_id", F.lit(chunk)), "chunk-rows")
    rows.write.mode("overwrite").option("compression", "gzip").option("ignoreNullFields", False).json(f"{folder}/rows/chunk_id={chunk}")
    count = rows.count()
    document = _document(chunk, pieces, params, lengths, count, candidates.count(), rows.schema)
    found.sparkSession.createDataFrame([(document,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/summaries/chunk_id={chunk}")
    return count


def summaries(spark: SparkSession, path: str, sample: str, analysis: str) -> list[dict]:
    """The summary documents of all chunks, a row a chunk; ValueError where they don't belong together or don't cover their
    contigs, each base once."""
    found = [json.loads(r["value"]) for r in spark.read.text(path).collect() if r["value"].strip()]
    if not found:
        raise ValueError("no chunk summaries")
    first = found[0]
    names, lengths = first.get("expected_contigs") or [], first.get("expected_contig_lengths")
    if not names or len(set(names)) < len(names):
        raise ValueError("summaries must declare the expected contigs, each once")
    if not isinstance(lengths, dict) or set(lengths) != set(names):
        raise ValueError("summaries must declare the length of each expected contig")
    ids = [s.get("chunk_id") for s in found]
    if not all(ids) or len(set(ids)) < len(ids):
        raise ValueError(f"missing or repeated chunk ids: {ids}")
    for s in found:
        for what, value in (("sample", sample), ("analysis", analysis), *((k, first[k]) for k in ("parameters", "expected_contigs", "expected_contig_lengths"))):
            if s.get(what) != value:
                raise ValueError(f"{s['chunk_id']}: another {what}")
        own = s.get("intervals")
        if not isinstance(own, list) or not own or not s.get("contigs"):
            raise ValueError(f"{s['chunk_id']}: no contigs or intervals")
        for x in own:
            if not isinstance(x, dict) or x.get("contig") not in lengths or not all(isinstance(x.get(k), int) for k in ("start", "end")) or not 0 <= x["start"] < x["end"] <= lengths[x["contig"]]:
                raise ValueError(f"{s['chunk_id']}: wrong interval {x}")
        if list(dict.fromkeys(x["contig"] for x in own)) != s["contigs"]:
            raise ValueError(f"{s['chunk_id']}: contigs and intervals disagree")
    owned = spark.createDataFrame([(s["chunk_id"], x["contig"], x["start"], x["end"]) for s in found for x in s["intervals"]], OWNED)
    contigs = spark.createDataFrame([(c, lengths[c]) for c in names], "contig string, length long")
    formats._refuse(intervals.coverage_faults(owned, contigs), "chunks leave out bases or share them")
    return found


def finalised(spark: SparkSession, folder: str, params: Params) -> tuple[DataFrame, int]:
    """(call table of all chunks, candidates) of what write_chunks has left in the folder: rows are checked against their
    chunk, the totals and each other; q values and filters are those of the whole sample."""
    documents = summaries(spark, f"{folder}/summaries", params.sample, params.analysis)
    rows = by_rows(written(formats.fragments(spark, f"{folder}/rows", StructType.fromJson(documents[0]["row_schema"])).drop("chunk_id"), "fragments"))
    owned = F.broadcast(spark.createDataFrame([(s["chunk_id"], x["contig"], x["start"], x["end"]) for s in documents for x in s["intervals"]], OWNED))
    inside = intervals.at_positions(rows, owned).where("chunk_id = _chunk_id")
    formats._refuse(rows.join(inside.select("contig", "pos", "strand", "_chunk_id"), ["contig", "pos", "strand", "_chunk_id"], "left_anti").select("_chunk_id", "contig", "pos"), "rows outside their chunk")
    expected, count = sum(s["reported_rows"] for s in documents), rows.count()
    if count != expected:
        raise ValueError(f"{expected} rows were reported, {count} are there")
    formats.unique_calls(rows.withColumnRenamed("pos", "position_0based"))
    tested = benjamini_hochberg(rows.drop("_chunk_id"), "control_fisher_p", "control_fisher_q", [], evidence.CALL)
    return calling.table(tested, params), sum(s["candidate_count"] for s in documents)
