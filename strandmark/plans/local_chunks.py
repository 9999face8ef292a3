"""A chunk called by itself: only reads near what it owns are looked at, and its rows are those of the whole call.

A chunk owns intervals, each with a scanned interval around it (formats.interval_table, planner.plan). Evidence of an isolated pile-up lies
within the padding. Pairs are assigned one to one, so a pair's fate hangs on its whole component, and that may reach beyond any fixed
padding: the scanned intervals are widened until each component with an owned pair is closed, that is, until no place at which one of
its endpoints could have another partner lies outside. A widening reads the reads of the scanned intervals and no others, counts their
pile-ups, and looks at no other evidence; it goes by steps that double, so a component of length n is closed after about log n of them.

Intervals are a few rows a chunk, held by the driver; reads are cut by conditions on contig and place, which reach the files.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmark.operators import double_strand, evidence, intervals, single_strand
from strandmark.plans.calling import Inputs
from strandmark.schema import Params
from strandmark.session import by_rows, written


@dataclass(frozen=True)
class Interval:
    contig: str
    start: int
    end: int
    scan_start: int
    scan_end: int


def of_table(table: DataFrame) -> list[Interval]:
    """Of an interval table's few rows."""
    rows = table.select("contig", "owner_start", "owner_end", "scan_start", "scan_end").orderBy("contig", "owner_start").collect()
    return [Interval(*r) for r in rows]


def _any(conditions: list[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def inside(ranges: list[tuple[str, int, int]], pos: str = "pos") -> Column:
    """Whether contig and ``pos`` lie in some [start, end)."""
    return _any([(F.col("contig") == c) & (F.col(pos) >= a) & (F.col(pos) < b) for c, a, b in ranges])


def near(ranges: list[tuple[str, int, int]]) -> Column:
    """Whether a read overlaps or touches some [start, end); each bound is a condition on one column, as files' statistics are."""
    return _any([(F.col("contig") == c) & (F.col("reference_start") < b) & (F.col("reference_end") >= a) for c, a, b in ranges])


def _merged(ranges: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    out: list[tuple[str, int, int]] = []
    for c, a, b in sorted(ranges):
        if out and out[-1][0] == c and a <= out[-1][2]:
            out[-1] = (c, out[-1][1], max(b, out[-1][2]))
        else:
            out.append((c, a, b))
    return out


def _owned_components(pairs: DataFrame, own: Column, overhang: int) -> DataFrame:
    """pairs, with ``component``, of components that hold an owned pair. Components are written: they are asked here twice, for the reach, and again by the call."""
    every = by_rows(written(double_strand.components(pairs, overhang), "components"))
    return every.join(every.where(own).select("contig", "component").distinct(), ["contig", "component"], "left_semi")


def _reach(pairs: DataFrame, scanned: list[tuple[str, int, int]], params: Params) -> list[tuple[str, int, int]]:
    """How far, by scanned interval, partners of the endpoints of ``pairs`` could lie: a row an interval that has any."""
    o, w = params.digenome_overhang, params.digenome_pair_window
    forward, reverse = F.col("forward_position"), F.col("reverse_position")
    low, high = F.least(forward - o - w, reverse + o - w), F.greatest(forward - o + w + 1, reverse + o + w + 1)
    where = reduce(lambda found, k: F.when((F.col("contig") == scanned[k][0]) & (forward >= scanned[k][1]) & (forward < scanned[k][2]), k).otherwise(found), range(len(scanned)), F.lit(None).cast("int"))
    rows = pairs.withColumn("_k", where).groupBy("_k").agg(F.min(low).alias("low"), F.max(high).alias("high")).collect()
    return [(scanned[r["_k"]][0], r["low"], r["high"]) for r in rows]


def closed(reads: DataFrame, lengths: dict[str, int], owned: list[Interval], params: Params, mask: DataFrame | None = None) -> tuple[DataFrame, list[tuple[str, int, int]], int]:
    """(pairs (PAIR) of all components with an owned pair, the scanned intervals that it took, widenings)."""
    o, w = params.digenome_overhang, params.digenome_pair_window
    own = inside([(x.contig, x.start, x.end) for x in owned], "forward_position")
    clip = lambda c, a, b: (c, max(0, a), min(lengths[c], b))
    scanned = _merged([clip(x.contig, min(x.scan_start, x.start - o - w), max(x.scan_end, x.end - o + w)) for x in owned])
    step, widened = max(1, abs(o) + w), 0
    while True:
        pairs = double_strand.edges(reads.where(near(scanned)), params, mask, inside(scanned))
        mine = _owned_components(pairs, own, o)
        wanted = [clip(*r) for r in _reach(mine, scanned, params)]
        more = []
        for c, a, b in wanted:
            now = next(s for s in scanned if s[0] == c and s[1] < b and a < s[2])
            if a < now[1] or b > now[2]:
                more.append(clip(c, min(a, now[1] - step) if a < now[1] else now[1], max(b, now[2] + step) if b > now[2] else now[2]))
        if not more:
            return mine.select(*double_strand.PAIR), scanned, widened
        scanned, step, widened = _merged(scanned + more), 2 * step, widened + 1


def call(inputs: Inputs, owned: list[Interval], params: Params) -> tuple[DataFrame, DataFrame, list[tuple[str, int, int]]]:
    """(candidates that the chunk owns, its call rows before q values and filters, the intervals whose reads were looked at)."""
    lengths = {r["contig"]: r["length"] for r in inputs.contigs.collect()}
    if unknown := sorted({x.contig for x in owned} - set(lengths)):
        raise ValueError(f"intervals on unknown contigs: {unknown}")
    mask = None if inputs.mask is None else by_rows(written(intervals.merge(inputs.mask), "mask"))
    own = [(x.contig, x.start, x.end) for x in owned]
    if params.analysis == "ndigenome":
        looked = _merged([(x.contig, max(0, min(x.scan_start, x.start - params.padding)), max(x.scan_end, x.end + params.padding)) for x in owned])
        some = replace(inputs, reads=inputs.reads.where(near(looked)))
        candidates, found = single_strand.calls(some.reads, params, mask, inside(own))
    else:
        pairs, scanned, _ = closed(inputs.reads, lengths, owned, params, mask)
        # the score looks two places around either anchor, one of them an overhang away
        pad = max(params.artifact_window, abs(params.digenome_overhang) + 3) + 1
        looked = _merged([(c, max(0, a - pad), b + pad) for c, a, b in scanned])
        some = replace(inputs, reads=inputs.reads.where(near(looked)))
        candidates, found = double_strand.calls(some.reads, inputs.contigs, params, mask, pairs, inside(own, "forward_position"))
    found = evidence.known_indels(found, inputs.variants, params.artifact_window)
    control = None if inputs.control is None else inputs.control.where(near(looked))
    return candidates, evidence.control(found, control, inputs.contigs, params, mask, adjust=False), looked
