"""Isolated one-strand pile-ups (analysis ``ndigenome``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmark.functions.statistics import pair_score
from strandmark.operators import sites as S
from strandmark.operators.intervals import BIN, outside
from strandmark.schema import METRICS, Params
from strandmark.session import by_rows, written


def scan(reads: DataFrame, params: Params, mask: DataFrame | None = None, own: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(scanned pile-ups, the reads cut to them and to where their opposites may be); only pile-ups for which ``own`` holds (on contig and
    pos), if given."""
    scanned = S.pileups(reads, params.ndigenome_min_count, params.ndigenome_min_mapq, mask)
    if own is not None:
        scanned = scanned.where(own)
    scanned = by_rows(written(scanned, "scanned"))
    return scanned, S.cut(reads, places(scanned, params), params.artifact_window)


def places(scanned: DataFrame, params: Params) -> DataFrame:
    """(contig, pos) at which evidence for the pile-ups is asked for: their own and those of opposites, one in each bin at least."""
    w = params.ndigenome_opposite_window
    low, high = F.greatest(F.col("pos") - w, F.lit(0)), F.col("pos") + w
    return scanned.select("contig", F.explode(F.array_union(F.sequence(low, high, F.lit(BIN).cast("long")), F.array("pos", high))).alias("pos"))


def focal(scanned: DataFrame, reads: DataFrame, params: Params, measured: DataFrame | None = None) -> DataFrame:
    """The scanned pile-ups whose fraction passes too, with their metrics; ``measured``: these, if they are known already."""
    if measured is None:
        measured = S.metrics(scanned, reads, params.artifact_window, params.ndigenome_min_mapq)
    return scanned.drop("count").join(measured, S.SITE).where(F.col("endpoint_fraction") >= params.ndigenome_min_fraction)


def best_opposite(sites: DataFrame, reads: DataFrame, params: Params, mask: DataFrame | None = None) -> DataFrame:
    """Each site with its best opposite endpoint within the window, if any: (site, opposite_position, opposite_count,
    opposite_depth, opposite_fraction). Offsets are exploded, so the band join is an equi-join."""
    w = params.ndigenome_opposite_window
    asked = sites.select(*S.SITE, F.when(F.col("strand") == "+", "-").otherwise("+").alias("o_strand"), F.explode(F.sequence(F.greatest(F.col("pos") - w, F.lit(0)), F.col("pos") + w)).alias("o_pos"))
    ends = S.endpoints(reads, params.ndigenome_min_mapq).select("contig", F.col("pos").alias("o_pos"), F.col("strand").alias("o_strand"))
    pairs = by_rows(written(outside(asked.join(ends, ["o_pos", "contig", "o_strand"]), mask, "o_pos"), "opposites"))
    measured = S.depths(pairs.select("contig", F.col("o_pos").alias("pos"), F.col("o_strand").alias("strand")), reads, params.ndigenome_min_mapq)
    measured = measured.select("contig", F.col("pos").alias("o_pos"), F.col("strand").alias("o_strand"), F.col("endpoint_count").alias("n"), F.col("strand_depth").alias("d"), F.col("endpoint_fraction").alias("f"))
    primary = (F.col("n") >= params.ndigenome_min_count) & (F.col("f") >= params.ndigenome_min_fraction)
    ambiguous = (F.col("n") >= params.ndigenome_ambiguous_min_count) | (F.col("f") >= params.ndigenome_ambiguous_min_fraction)
    rank = F.struct(primary, ambiguous, F.col("n"), F.col("f"), -F.abs(F.col("o_pos") - F.col("pos")), -F.col("o_pos"))
    best = pairs.join(measured, ["contig", "o_pos", "o_strand"]).groupBy(*S.SITE).agg(F.max_by(F.struct("o_pos", "n", "d", "f"), rank).alias("b"))
    return best.select(*S.SITE, F.col("b.o_pos").alias("opposite_position"), F.col("b.n").alias("opposite_count"), F.col("b.d").alias("opposite_depth"), F.col("b.f").alias("opposite_fraction"))


def signal(params: Params):
    primary = (F.col("opposite_count") >= params.ndigenome_min_count) & (F.col("opposite_fraction") >= params.ndigenome_min_fraction)
    ambiguous = (F.col("opposite_count") >= params.ndigenome_ambiguous_min_count) | (F.col("opposite_fraction") >= params.ndigenome_ambiguous_min_fraction)
    return F.when(primary, "POSSIBLE_DSB").when(ambiguous, "AMBIGUOUS").otherwise("SSB")


def calls(reads: DataFrame, params: Params, mask: DataFrame | None = None, own: Column | None = None, scanned: DataFrame | None = None, measured: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(scanned pile-ups, call rows before controls and filters). ``scanned`` and ``measured``, with cut reads: pile-ups and their metrics, if they are known already."""
    if scanned is None:
        scanned, reads = scan(reads, params, mask, own)
    sites = by_rows(written(focal(scanned, reads, params, measured), "sites"))  # few rows of many reads, and read several times from here on
    best = by_rows(written(best_opposite(sites, reads, params, mask), "best-opposites"))
    # of written tables from here on, so that the wide rows are put together where they are wanted, and nowhere before
    found = sites.join(best, S.SITE, "left")
    found = found.fillna({"opposite_count": 0, "opposite_depth": 0, "opposite_fraction": 0.0}).withColumn("signal_classification", signal(params))
    plus = F.col("strand") == "+"
    either = lambda own, other: (F.when(plus, F.col(own)).otherwise(F.col(other)), F.when(plus, F.col(other)).otherwise(F.col(own)))
    for name, own, other in (("position_0based", "pos", "opposite_position"), ("endpoint_count", "endpoint_count", "opposite_count"), ("depth", "strand_depth", "opposite_depth"), ("fraction", "endpoint_fraction", "opposite_fraction")):
        forward, reverse = either(own, other)
        found = found.withColumns({f"forward_{name}": forward, f"reverse_{name}": reverse})
    score = pair_score(F.col("forward_endpoint_count"), F.col("forward_fraction"), F.col("reverse_endpoint_count"), F.col("reverse_fraction"))
    found = found.withColumns(
        {
            "digenome_pair_score": F.when(F.col("opposite_position").isNotNull(), score).otherwise(0.0),
            "rgen_digenome_score": F.lit(None).cast("double"),
            "opposite_position_0based": F.col("opposite_position"),
            "caller_reasons": F.array().cast("array<string>"),
        }
    )
    keep = [c for c in found.columns if c != "opposite_position"]
    assert set(METRICS) <= set(keep)
    return scanned, found.select(*keep)
