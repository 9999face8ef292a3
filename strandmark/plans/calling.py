"""The whole call: checks of the inputs, candidates, variants, control, filters, as one lazy plan; of one analysis or of several."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmark.operators import double_strand, evidence, filters, intervals, single_strand, sites
from strandmark.schema import Params
from strandmark.session import by_rows, written
from strandmark.sources import formats


@dataclass(frozen=True)
class Inputs:
    """reads, contigs(contig, length[, ordinal]), and what may be absent: control reads, variants, an interval mask, and the
    contigs that the control and the variants' header declare, which are compared with ``contigs``."""

    reads: DataFrame
    contigs: DataFrame
    control: DataFrame | None = None
    variants: DataFrame | None = None
    mask: DataFrame | None = None
    control_contigs: DataFrame | None = None
    variant_contigs: DataFrame | None = None


@dataclass(frozen=True)
class Calls:
    table: DataFrame
    #: Scanned pile-ups (ndigenome) or candidate pairs (digenome).
    candidates: DataFrame


def check(inputs: Inputs, params: Params) -> None:
    """Raises ValueError unless the inputs fit each other and the analysis."""
    paired = params.analysis == "ndigenome"
    sites.layout(inputs.reads, params.min_mapq, paired)
    if inputs.control is not None:
        sites.layout(inputs.control, params.min_mapq, paired)
    if inputs.control_contigs is not None:
        formats.same_contigs(inputs.contigs, inputs.control_contigs)
    if inputs.variant_contigs is not None:
        formats.check_contigs(inputs.contigs, inputs.variant_contigs, "the variants' header")
    if inputs.mask is not None:
        whole = inputs.mask.join(inputs.contigs.select("contig", "length"), "contig", "left")
        formats._refuse(whole.where("length IS NULL OR start < 0 OR start >= `end` OR `end` > length"), "the mask has intervals outside the contigs")


def rows(inputs: Inputs, params: Params) -> tuple[DataFrame, DataFrame]:
    """(candidates, call rows with all evidence, before the filters)."""
    mask = None if inputs.mask is None else by_rows(written(intervals.merge(inputs.mask), "mask"))
    if params.analysis == "ndigenome":
        candidates, found = single_strand.calls(inputs.reads, params, mask)
    else:
        candidates, found = double_strand.calls(inputs.reads, inputs.contigs, params, mask)
    found = evidence.known_indels(found, inputs.variants, params.artifact_window)
    return candidates, evidence.control(found, inputs.control, inputs.contigs, params, mask)


def several(inputs: Inputs, params: list[Params]) -> list[tuple[DataFrame, DataFrame]]:
    """``rows`` of several analyses. Where they have the same window and minimum of mapping quality, all that looks at reads is done once for all of them: pile-ups,
    the cut, the metrics at their sites, the control's cut and depths."""
    if len(params) < 2 or len({(p.min_mapq, p.artifact_window) for p in params}) > 1:
        return [rows(inputs, p) for p in params]
    mask = None if inputs.mask is None else by_rows(written(intervals.merge(inputs.mask), "mask"))
    single = [p.analysis == "ndigenome" for p in params]
    least = min(p.ndigenome_min_count if s else double_strand.least_count(p) for p, s in zip(params, single))
    piles = by_rows(written(sites.pileups(inputs.reads, least, params[0].min_mapq, mask), "piles"))
    # what is looked at (pile-ups or pairs), the sites of it, the places of its evidence
    looked = [piles.where(F.col("count") >= p.ndigenome_min_count) if s else double_strand.edges(inputs.reads, p, piles=piles) for p, s in zip(params, single)]
    union = lambda tables: reduce(DataFrame.unionByName, tables)
    places = union([single_strand.places(x, p) if s else double_strand.grid_places(x, p.digenome_overhang) for x, p, s in zip(looked, params, single)])
    near = sites.cut(inputs.reads, places, max(map(double_strand.reach, params)))
    wanted = union([x.select(*sites.SITE) if s else double_strand.sides(x) for x, s in zip(looked, single)])
    measured = by_rows(written(sites.metrics(wanted, near, params[0].artifact_window, params[0].min_mapq), "measured"))
    out = []
    for x, p, s in zip(looked, params, single):
        if s:
            candidates, found = single_strand.calls(near, p, mask, scanned=x, measured=measured)
        else:
            candidates, found = double_strand.calls(near, inputs.contigs, p, mask, pairs=x, measured=measured)
        found = evidence.known_indels(found, inputs.variants, p.artifact_window)
        out.append((candidates, found))
    if inputs.control is None:
        return [(candidates, evidence.control(found, None, inputs.contigs, p, mask)) for (candidates, found), p in zip(out, params)]
    asked = [evidence.slim(found, p) for (_, found), p in zip(out, params)]
    control, depths = evidence.control_reads([*zip(asked, params)], inputs.control)
    return [(candidates, evidence.control(found, control, inputs.contigs, p, mask, asked=(few, depths))) for (candidates, found), few, p in zip(out, asked, params)]


def table(found: DataFrame, params: Params) -> DataFrame:
    return filters.call_table(filters.classified(found, params), params)


def call(inputs: Inputs, params: Params, checks: bool = True) -> Calls:
    """The calls; with ``checks`` the inputs are checked first, which takes a look at each of them."""
    return calls(inputs, [params], checks)[0]


def calls(inputs: Inputs, params: list[Params], checks: bool = True) -> list[Calls]:
    """The calls of several analyses of the same inputs, see ``several``."""
    if checks:
        for p in params:
            check(inputs, p)
    return [Calls(table(found, p), candidates) for p, (candidates, found) in zip(params, several(inputs, params))]


def position(candidates: DataFrame) -> DataFrame:
    """(contig, pos) by which a candidate belongs to an interval: its own place, or the forward one of a pair."""
    return candidates.select("contig", F.col("pos" if "pos" in candidates.columns else "forward_position").alias("pos"))
