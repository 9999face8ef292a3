"""Controls and known variants of call rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmark.functions.statistics import benjamini_hochberg, fisher, fold_enrichment, pair_score
from strandmark.operators import double_strand as D
from strandmark.operators import intervals
from strandmark.operators import sites as S
from strandmark.schema import Params
from strandmark.session import by_rows, written

CALL = ["contig", "pos", "strand"]


def indel_labels(variants: DataFrame) -> DataFrame:
    """variants(contig, pos 1-based, ref, alts[, end]) that change length, as (contig, start, end, label). A variant covers its
    reference bases, and all up to ``end`` where that is given, as for symbolic alleles."""
    alts = F.filter("alts", lambda a: (a != "") & (F.length(a) != F.length("ref")))
    found = variants.withColumn("_alts", alts).where(F.size("_alts") > 0)
    start = F.col("pos") - 1
    label = F.concat("contig", F.lit(":"), F.col("pos").cast("string"), F.lit(":"), "ref", F.lit(">"), F.array_join("_alts", ","))
    last = start + F.greatest(F.length("ref"), F.lit(1))
    last = F.greatest(last, F.col("end")) if "end" in variants.columns else last
    return found.select("contig", start.alias("start"), last.alias("end"), label.alias("label"))


def known_indels(calls: DataFrame, variants: DataFrame | None, window: int) -> DataFrame:
    """calls with ``known_indel_overlap``: labels of variants within the window of the call's one or two positions."""
    if variants is None:
        return calls.withColumn("known_indel_overlap", F.lit(""))
    points = calls.select(*CALL, F.explode(F.array_distinct(F.array_compact(F.array("pos", "opposite_position_0based")))).alias("at"))
    wide = by_rows(written(indel_labels(variants), "known-indels")).withColumns({"start": F.greatest(F.col("start") - window, F.lit(0)), "end": F.col("end") + window})
    hits = intervals.at_positions(points.withColumnRenamed("pos", "_pos"), wide, "at").groupBy("contig", F.col("_pos").alias("pos"), "strand")
    labels = by_rows(written(hits.agg(F.array_join(F.array_sort(F.collect_set("label")), ";").alias("known_indel_overlap")), "labels"))
    return calls.join(labels, CALL, "left").fillna({"known_indel_overlap": ""})


def _asked(calls: DataFrame, params: Params) -> DataFrame:
    """(contig, pos, strand) at which the control's depth is asked for."""
    return D.sides(calls, "forward_position_0based", "reverse_position_0based") if params.analysis == "digenome" else calls.select(*CALL)


def _places(calls: DataFrame, params: Params) -> DataFrame:
    if params.analysis == "digenome":
        return D.grid_places(calls.select("contig", F.col("forward_position_0based").alias("forward_position"), F.col("reverse_position_0based").alias("reverse_position")), params.digenome_overhang)
    return calls.select("contig", "pos")


def slim(calls: DataFrame, params: Params) -> DataFrame:
    """What the control is asked about, and Fisher's test needs: the calls' few columns of that, written."""
    own = ["forward_position_0based", "reverse_position_0based"] if params.analysis == "digenome" else []
    return by_rows(written(calls.select(*[c for c in ("sample", "analysis") if c in calls.columns], *CALL, *own, "endpoint_count", "strand_depth"), "calls"))


def control_reads(several: list[tuple[DataFrame, Params]], reads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the control's reads cut to what slim calls ask for, its depths at their sites, written). Of several analyses with one minimum of mapping quality, once."""
    union = lambda tables: reduce(DataFrame.unionByName, tables)
    reach = max(D.grid_reach(p.digenome_overhang) if p.analysis == "digenome" else 0 for _, p in several)
    near = S.cut(reads, union([_places(c, p) for c, p in several]), reach)
    found = S.depths(union([_asked(c, p) for c, p in several]), near, several[0][1].min_mapq)
    found = found.select(*CALL, F.struct(F.col("endpoint_count").alias("n"), F.col("strand_depth").alias("d"), F.col("endpoint_fraction").alias("f")).alias("c"))
    return near, by_rows(written(found, "control-depths"))  # both sides are of it


def control(calls: DataFrame, reads: DataFrame | None, contigs: DataFrame, params: Params, mask: DataFrame | None = None, adjust: bool = True, asked: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """calls with the control's evidence at the same sites, Fisher's test against it, and q values over all of them (null without ``adjust``,
    where these calls aren't the whole sample). ``asked``: the calls as ``slim`` and the depths of ``control_reads``, with reads cut by it, if there are such already.

    The evidence is put together beside the calls, in few columns, and joined to their many once, when these are wanted.
    """
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("double")
    parts = ("endpoint_count", "depth", "fraction")
    if reads is None:
        empty = {f"control_{s}{p}": F.lit(0.0) if p == "fraction" else zero for s in ("", "forward_", "reverse_") for p in parts}
        names = ("control_digenome_pair_score", "control_rgen_digenome_score", "control_fold_enrichment", "control_fisher_p", "control_fisher_q")
        return calls.withColumns(empty | {n: none for n in names} | {"control_sample": F.lit(""), "control_status": F.lit("UNCONTROLLED")})
    both = params.analysis == "digenome"
    if asked is None:
        few = slim(calls, params)
        reads, depths = control_reads([(few, params)], reads)
    else:
        few, depths = asked
    by = [c for c in ("sample", "analysis") if c in calls.columns]
    own = [c for c in few.columns if c.endswith("_0based")]
    out = few.withColumnsRenamed({"endpoint_count": "_n", "strand_depth": "_d"})
    nothing = F.struct(zero.alias("n"), zero.alias("d"), F.lit(0.0).alias("f"))
    if both:
        for side, strand in (("forward", "+"), ("reverse", "-")):
            found = depths.where(F.col("strand") == strand).select("contig", F.col("pos").alias(f"{side}_position_0based"), F.col("c").alias(f"_{side}"))
            out = out.join(found, [f"{side}_position_0based", "contig"], "left").withColumn(f"_{side}", F.coalesce(f"_{side}", nothing))
    else:
        out = out.join(depths, ["pos", "contig", "strand"], "left")
        out = out.withColumns({f"_{side}": F.when(F.col("strand") == strand, F.coalesce("c", nothing)).otherwise(nothing) for side, strand in (("forward", "+"), ("reverse", "-"))})
    out = out.withColumns({f"control_{side}_{p}": F.col(f"_{side}.{p[0] if p != 'endpoint_count' else 'n'}") for side in ("forward", "reverse") for p in parts})
    n, d = F.col("_forward.n") + F.col("_reverse.n"), F.col("_forward.d") + F.col("_reverse.d")
    out = out.withColumns({"control_endpoint_count": n, "control_depth": d, "control_fraction": F.coalesce(F.try_divide(n.cast("double"), d.cast("double")), F.lit(0.0))}).drop("_forward", "_reverse")
    if both:
        score = pair_score(F.col("control_forward_endpoint_count"), F.col("control_forward_fraction"), F.col("control_reverse_endpoint_count"), F.col("control_reverse_fraction"))
        single = D.single_precision_score(few.select("contig", F.col("forward_position_0based").alias("forward_position")), reads, contigs, params.digenome_overhang, params.min_mapq, mask, "control_rgen_digenome_score")
        out = out.withColumn("control_digenome_pair_score", score).join(single.withColumnRenamed("forward_position", "forward_position_0based"), ["contig", "forward_position_0based"], "left")
    else:
        out = out.withColumns({"control_digenome_pair_score": none, "control_rgen_digenome_score": none})
    enough = F.col("control_depth") >= params.control_min_depth
    rest = lambda depth, n: F.greatest(F.lit(0).cast("long"), F.col(depth) - F.col(n))
    p = fisher(F.col("_n"), rest("_d", "_n"), F.col("control_endpoint_count"), rest("control_depth", "control_endpoint_count"))
    fold = fold_enrichment(F.col("_n"), F.col("_d"), F.col("control_endpoint_count"), F.col("control_depth"))
    out = out.withColumn("_p", p).withColumns(
        {
            "control_sample": F.lit(params.control_sample),
            "control_status": F.when(enough, "MATCHED_CONTROL").otherwise("INSUFFICIENT_CONTROL_COVERAGE"),
            "control_fold_enrichment": F.when(enough, fold),
            "control_fisher_p": F.when(enough, F.col("_p")),
        }
    )
    out = out.drop("_p", "_n", "_d", "c", *own)
    if adjust:
        out = benjamini_hochberg(by_rows(written(out, "tested")), "control_fisher_p", "control_fisher_q", by, CALL)
    else:
        out = out.withColumn("control_fisher_q", none)
    return calls.join(out, [*by, *CALL])
