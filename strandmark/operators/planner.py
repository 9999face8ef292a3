"""Balanced genomic chunks, for reports and external schedulers; Spark itself partitions by key.

A contig weighs its mapped records times the share of its bases that the mask leaves open. Laid end to end in header order,
contigs make one line of weight, which is cut into equal parts by exact fractions; within a contig weight is spread evenly
over the open bases. A piece between two cuts belongs to the part in which its weight's midpoint lies; parts without a piece
vanish. A contig that the mask hides whole weighs nothing but still is in a chunk.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from fractions import Fraction
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmark.operators import intervals

INTERVALS = ["contig", "owner_start", "owner_end", "scan_start", "scan_end", "callable_bases", "excluded_bases"]


def rounded(x: Fraction) -> int:
    """Half up."""
    return (2 * x.numerator + x.denominator) // (2 * x.denominator)


class OpenBases:
    """The open segments of a contig, ascending."""

    def __init__(self, segments: list[tuple[int, int]]) -> None:
        self.segments = segments
        self.total = self.before(segments[-1][1]) if segments else 0

    def before(self, coordinate: int) -> int:
        """Open bases left of a coordinate."""
        return sum(max(0, min(coordinate, end) - start) for start, end in self.segments)

    def coordinate(self, bases: Fraction) -> int:
        """Where so many open bases (more than none) lie to the left, rounded within the segment."""
        for start, end in self.segments:
            if bases <= end - start:
                return start + rounded(bases)
            bases -= end - start
        return self.segments[-1][1]


def plan(density: DataFrame, contigs: DataFrame, chunks: int, padding: int = 0, mask: DataFrame | None = None) -> list[dict]:
    """A row for each owned interval, with its chunk's records: all mapped ones, and those in open bases.

    density(contig, mapped) and contigs(contig, length[, ordinal]) are a row a contig; all the rest is arithmetic on those
    few rows. Contigs go in the order of ``ordinal``, or by name without it. ValueError if nothing is mapped.
    """
    if chunks < 1 or padding < 0:
        raise ValueError("chunks must be positive and padding not negative")
    order = "ordinal" if "ordinal" in contigs.columns else "contig"
    lengths = {r["contig"]: r["length"] for r in contigs.orderBy(order).collect()}
    mapped = {r["contig"]: r["mapped"] for r in density.collect() if r["mapped"] > 0}
    if not mapped:
        raise ValueError("no mapped records")
    whole = contigs.where(F.col("contig").isin(list(mapped))).select("contig", F.lit(0).cast("long").alias("start"), F.col("length").alias("end"))
    left = intervals.subtract(whole, intervals.merge(mask)) if mask is not None else whole
    segments = defaultdict(list)
    for r in left.orderBy("contig", "start").collect():
        segments[r["contig"]].append((r["start"], r["end"]))
    names = [c for c in lengths if c in mapped]
    open_ = {c: OpenBases(segments[c]) for c in names}
    a_base = {c: Fraction(mapped[c], lengths[c]) for c in names}
    total = sum(a_base[c] * open_[c].total for c in names)
    parts = min(chunks, sum(mapped[c] for c in names), sum(o.total for o in open_.values())) if total else 1
    cuts = [total * k / parts for k in range(1, parts)]
    found, origin = defaultdict(list), Fraction(0)
    for c in names:
        end = origin + a_base[c] * open_[c].total
        bounds = [0]
        for cut in cuts[bisect_right(cuts, origin) :]:
            if cut >= end:
                break
            at = open_[c].coordinate((cut - origin) / a_base[c])
            at = max(bounds[-1] + 1, min(lengths[c] - 1, at))
            bounds += [at] if at < lengths[c] else []
        for a, b in pairwise([*bounds, lengths[c]]):
            own = open_[c].before(b) - open_[c].before(a)
            middle = origin + a_base[c] * (open_[c].before(a) + Fraction(own, 2))
            found[bisect_right(cuts, middle)].append((c, a, b, own))
        origin = end
    width = max(3, len(str(len(found) - 1)))
    rows = []
    for number, (_, pieces) in enumerate(sorted(found.items())):
        records = rounded(sum(a_base[c] * (b - a) for c, a, b, _ in pieces))
        open_records = rounded(sum(a_base[c] * own for c, _, _, own in pieces))
        for c, a, b, own in pieces:
            rows.append(
                {"chunk_id": f"chunk_{number:0{width}d}", "contig": c, "owner_start": a, "owner_end": b, "scan_start": max(0, a - padding), "scan_end": min(lengths[c], b + padding), "callable_bases": own, "excluded_bases": b - a - own, "mapped_records": records, "callable_mapped_records": open_records}
            )
    return rows


def plan_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame(rows, "chunk_id string, contig string, owner_start long, owner_end long, scan_start long, scan_end long, callable_bases long, excluded_bases long, mapped_records long, callable_mapped_records long")


def chunk_table(plan: DataFrame) -> DataFrame:
    """A row a chunk of plan_frame; its intervals as text, in the order of the plan."""
    ordered = plan.withColumn("_k", F.monotonically_increasing_id())
    text = F.format_string("%s:%d-%d", "contig", "owner_start", "owner_end")
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_k", text.alias("t")))), lambda x: x["t"]), ",")
    total = lambda c: F.sum(c).alias(c)
    owned = F.sum(F.col("owner_end") - F.col("owner_start")).alias("owned_bases")
    found = ordered.groupBy("chunk_id").agg(
        F.count("*").alias("interval_count"), F.count_distinct("contig").alias("contig_count"), F.first("mapped_records").alias("estimated_mapped_records"), F.first("callable_mapped_records").alias("estimated_callable_mapped_records"),
        owned, total("callable_bases"), total("excluded_bases"), listed.alias("intervals"),
    )
    return found


def write_plan(spark: SparkSession, rows: list[dict], folder: str) -> None:
    """``plan`` (a row a chunk, one file) and ``intervals/chunk_id=...`` (an interval table a chunk), tab-separated."""
    if not rows:
        raise ValueError("no chunks")
    frame = plan_frame(spark, rows).coalesce(1)
    chunk_table(frame).coalesce(1).sortWithinPartitions("chunk_id").write.option("sep", "\t").option("header", True).csv(f"{folder}/plan")
    frame.select("chunk_id", *INTERVALS).write.partitionBy("chunk_id").option("sep", "\t").option("header", True).csv(f"{folder}/intervals")
