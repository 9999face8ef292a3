"""Endpoint pile-ups and the evidence around sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandmark.functions import reads as R
from strandmark.functions.statistics import mean_or_zero, ratio
from strandmark.operators import intervals
from strandmark.session import by_rows, written

SITE = ["contig", "pos", "strand"]


#: Bins of a row of the map of wanted bins, and of one of its words.
BLOCK, WORD = 4096, 64
CUT = ["contig", "_bin", "read_ord", "query_name", "flag", "reference_start", "reference_end", "mapping_quality", "cigar", "nm"]


def bin_map(places: DataFrame) -> DataFrame:
    """(contig, _block, words): the bins of places(contig, pos) as bits, a row for BLOCK bins. It has a bit for 1,024 bases at most, so
    its size is bounded by the contigs' lengths (three gigabases: 3 million bits), however many places there are."""
    b = F.floor(F.col("pos") / intervals.BIN)
    words = places.where("pos >= 0").select("contig", b.alias("_b")).groupBy("contig", F.floor(F.col("_b") / BLOCK).alias("_block"), (F.floor(F.col("_b") / WORD) % (BLOCK // WORD)).cast("int").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(_b % 64 as int)))").alias("bits"))
    return words.groupBy("contig", "_block").agg(F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("words"))


def cut(reads: DataFrame, places: DataFrame, reach: int) -> DataFrame:
    """The reads that can be evidence at places(contig, pos), once and for all: a row for each read and each bin that holds a
    place and lies within ``reach`` of the read. What ``metrics``, ``depths``, ``single_base`` and ``endpoints`` make of them at these places (with
    windows up to ``reach``) is what they make of all reads; so of ``around`` with offsets up to it.

    One pass, without an exchange: the map of bins is broadcast, its size is bounded. Rows are slim (a CIGAR only where it
    has clips or indels, a name only with indels) and written, so that the steps that follow read these few and no others.
    """
    if "_bin" in reads.columns:
        return reads
    some = reads.where(~R.has(R.UNMAPPED | R.QCFAIL))
    some = some.withColumns({"query_name": F.when(F.col("cigar").rlike("[ID]"), F.col("query_name")), "cigar": F.when(F.col("cigar").rlike("[IDSH]"), F.col("cigar"))})
    binned = intervals.with_bins(some, F.greatest(F.col("reference_start") - reach, F.lit(0)), F.col("reference_end") + reach).withColumn("_block", F.floor(F.col("_bin") / BLOCK))
    wanted = written(bin_map(places), "bins")
    near = binned.join(F.broadcast(wanted), ["contig", "_block"])
    word = F.coalesce(F.try_element_at("words", (F.floor(F.col("_bin") / WORD) % (BLOCK // WORD)).cast("int")), F.lit(0).cast("long"))
    return by_rows(written(near.where(F.getbit(word, (F.col("_bin") % WORD).cast("int")) == 1).select(*CUT), "cut-reads"))


def _binned(reads: DataFrame, low: Column, high: Column) -> DataFrame:
    return reads if "_bin" in reads.columns else intervals.with_bins(reads, low, high)


def endpoints(reads: DataFrame, min_mapq: int, places: DataFrame | None = None) -> DataFrame:
    """(contig, pos, strand, count) of eligible reads' 5' ends; pre-aggregated before the shuffle. Only at ``places``, if given. Of cut reads, the
    row of the endpoint's own bin counts."""
    if "_bin" in reads.columns:
        reads = reads.where(F.col("_bin") == F.floor(R.endpoint() / intervals.BIN))
    ends = reads.where(R.eligible(min_mapq)).select("contig", R.endpoint().alias("pos"), R.strand().alias("strand"))
    ends = ends if places is None else ends.join(places, SITE, "left_semi")
    return ends.groupBy(*SITE).agg(F.count("*").alias("count"))


def pileups(reads: DataFrame, min_count: int, min_mapq: int, mask: DataFrame | None = None) -> DataFrame:
    """Endpoints with at least min_count reads outside the mask. The mask hides endpoints, never reads."""
    return intervals.outside(endpoints(reads, min_mapq).where(F.col("count") >= min_count), mask)


def _around(sites: DataFrame, reads: DataFrame, window: int) -> DataFrame:
    """Each site with the reads that overlap [pos - window, pos + window + 1)."""
    s = sites.select(*SITE).distinct().withColumn("_bin", F.floor(F.col("pos") / intervals.BIN))
    r = _binned(reads.where(~R.has(R.UNMAPPED)), F.greatest(F.col("reference_start") - window, F.lit(0)), F.col("reference_end") + window)
    near = (F.col("reference_start") < F.col("pos") + window + 1) & (F.col("reference_end") > F.greatest(F.col("pos") - window, F.lit(0)))
    return s.join(r, ["_bin", "contig"]).where(near)  # sorted by a number first: contigs are few


def depths(sites: DataFrame, reads: DataFrame, min_mapq: int) -> DataFrame:
    """Endpoint count, same-strand depth and their ratio only."""
    binned = ["_bin"] if "_bin" in reads.columns else []
    r = reads.where(R.eligible(min_mapq)).select("contig", *binned, "flag", "reference_start", "reference_end", R.strand().alias("r_strand"), R.endpoint().alias("r_end"))
    near = _around(sites, r, 0).where("r_strand = strand")
    found = near.groupBy(*SITE).agg(F.count_if(F.col("r_end") == F.col("pos")).alias("endpoint_count"), F.count("*").alias("strand_depth"))
    return found.withColumn("endpoint_fraction", ratio(F.col("endpoint_count"), F.col("strand_depth")))


def metrics(sites: DataFrame, reads: DataFrame, window: int, min_mapq: int) -> DataFrame:
    """The local evidence at each distinct site(contig, pos, strand) that any read is near; 19 columns.

    Mean MAPQ and NM, indels: both strands, over the window; depth and endpoints: the site's strand, at the site.
    """
    useful = [c for c in CUT if c in reads.columns]
    near = _around(sites, reads.where(~R.has(R.QCFAIL)).select(*useful), window)
    primary, same, at = R.eligible(min_mapq), R.strand() == F.col("strand"), R.endpoint() == F.col("pos")
    covers = (F.col("reference_start") <= F.col("pos")) & (F.col("pos") < F.col("reference_end"))
    near = near.withColumns({"_p": primary, "_e": primary & same & at, "_d": primary & same & covers, "_s": R.diagnostic(min_mapq) & same & at})
    on = lambda flag, value: F.when(F.col(flag), value)
    base = near.groupBy(*SITE).agg(
        F.count_if("_e").alias("endpoint_count"),
        F.count_if("_d").alias("strand_depth"),
        mean_or_zero(on("_e", F.col("mapping_quality"))).alias("support_mean_mapq"),
        F.count_if("_e").alias("support_read_count"),
        mean_or_zero(on("_p", F.col("mapping_quality"))).alias("local_mean_mapq"),
        F.count_if("_p").alias("local_read_count"),
        mean_or_zero(on("_e", F.col("nm"))).alias("support_mean_nm"),
        F.count(on("_e", F.col("nm"))).alias("support_nm_count"),
        mean_or_zero(on("_p", F.col("nm"))).alias("local_mean_nm"),
        F.count(on("_p", F.col("nm"))).alias("local_nm_count"),
        F.count_if(F.col("_e") & (R.five_prime_clip() > 0)).alias("softclipped_count"),
        F.count_if("_s").alias("secondary_endpoint_count"),
    )
    found = base.join(modal_indels(near.where("_p"), window), SITE, "left")
    return found.select(
        *SITE, "endpoint_count", "strand_depth", ratio(F.col("endpoint_count"), F.col("strand_depth")).alias("endpoint_fraction"),
        "support_mean_mapq", "support_read_count", "local_mean_mapq", "local_read_count", "support_mean_nm", "support_nm_count", "local_mean_nm", "local_nm_count",
        ratio(F.col("softclipped_count"), F.col("endpoint_count")).alias("softclip_fraction"), "softclipped_count", "secondary_endpoint_count",
        F.col("indel.pos").alias("indel_position"), F.coalesce("indel.kind", F.lit("")).alias("indel_type"), F.coalesce("indel.length", F.lit(0)).cast("long").alias("indel_length"),
        F.coalesce("indel_read_count", F.lit(0)).alias("indel_read_count"), ratio(F.coalesce("indel_read_count", F.lit(0)), F.col("local_read_count")).alias("indel_fraction"),
    )


def modal_indels(near: DataFrame, window: int) -> DataFrame:
    """(site, indel, indel_read_count): the most frequent indel near a site (ties: the first met in read order), and
    how many alignments have any there."""
    low, high = F.greatest(F.col("pos") - window, F.lit(0)), F.col("pos") + window + 1
    events = near.where(F.col("cigar").rlike("[ID]")).select(*SITE, "read_ord", "query_name", "flag", "reference_start", F.posexplode(R.indel_events()).alias("_k", "event"))
    deletion = (F.col("event.pos") < high) & (F.col("event.pos") + F.col("event.length") > low)
    events = events.where(F.when(F.col("event.kind") == "DEL", deletion).otherwise((low <= F.col("event.pos")) & (F.col("event.pos") < high)))
    events = by_rows(written(events.select(*SITE, "read_ord", "query_name", "flag", "reference_start", "_k", "event"), "indel-events"))  # both aggregations are of it
    counted = events.groupBy(*SITE, "event").agg(F.count("*").alias("n"), F.min(F.struct("read_ord", "_k")).alias("first"))
    rank = F.struct(F.col("n"), -F.col("first.read_ord"), -F.col("first._k"), -F.col("event.pos"))
    modal = counted.groupBy(*SITE).agg(F.max_by("event", rank).alias("indel"))
    alignments = events.groupBy(*SITE).agg(F.count_distinct("query_name", "flag", "reference_start").alias("indel_read_count"))
    return modal.join(alignments, SITE)


def around(anchors: DataFrame, reads: DataFrame, offsets: list[int], min_mapq: int) -> DataFrame:
    """(contig, pos, f0, r0, d0, f1, ...) at the distinct anchors(contig, pos) that any read is near: forward and reverse endpoints and depth at
    pos + offsets[0], pos + offsets[1], ...; a read meets an anchor once, however many places around it are asked for."""
    low, high = min(offsets), max(offsets)
    binned = ["_bin"] if "_bin" in reads.columns else []
    r = reads.where(R.eligible_rgen(min_mapq)).select("contig", *binned, "flag", "reference_start", "reference_end")
    r = _binned(r, F.greatest(F.col("reference_start") - high, F.lit(0)), F.col("reference_end") - low)
    a = anchors.select("contig", "pos").distinct().withColumn("_bin", F.floor(F.col("pos") / intervals.BIN))
    near = a.join(r, ["_bin", "contig"]).where((F.col("reference_start") <= F.col("pos") + high) & (F.col("reference_end") > F.col("pos") + low))
    near = near.select("contig", "pos", "reference_start", "reference_end", R.has(R.REVERSE).alias("_back"), (R.endpoint() - F.col("pos")).alias("_at"))
    counts = []
    for n, k in enumerate(offsets):
        covers = (F.col("reference_start") <= F.col("pos") + k) & (F.col("pos") + k < F.col("reference_end"))
        ends = covers & (F.col("_at") == k)
        counts += [F.count_if(ends & ~F.col("_back")).alias(f"f{n}"), F.count_if(ends & F.col("_back")).alias(f"r{n}"), F.count_if(covers).alias(f"d{n}")]
    return near.groupBy("contig", "pos").agg(*counts)


def single_base(positions: DataFrame, reads: DataFrame, min_mapq: int) -> DataFrame:
    """(contig, pos, forward_endpoint_count, reverse_endpoint_count, total_depth) at positions(contig, pos) with depth."""
    return around(positions, reads, [0], min_mapq).withColumnsRenamed({"f0": "forward_endpoint_count", "r0": "reverse_endpoint_count", "d0": "total_depth"})


def flagstat(reads: DataFrame) -> DataFrame:
    """Counts by flag, one row."""
    kinds = {"paired": R.PAIRED, "unmapped": R.UNMAPPED, "secondary": R.SECONDARY, "qcfail": R.QCFAIL, "duplicates": R.DUPLICATE, "supplementary": R.SUPPLEMENTARY, "reverse": R.REVERSE}
    return reads.agg(F.count("*").alias("total"), *[F.count_if(R.has(b)).alias(n) for n, b in kinds.items()], F.count_if(~R.has(R.UNMAPPED)).alias("mapped"))


def contig_density(reads: DataFrame) -> DataFrame:
    """Mapped records by contig, whatever their other flags."""
    return reads.where(~R.has(R.UNMAPPED)).groupBy("contig").agg(F.count("*").alias("mapped"))


def layout(reads: DataFrame, min_mapq: int, require_paired: bool, most: int = 10_000) -> None:
    """Raises unless there are eligible reads (and one of some ``most`` of them is paired)."""
    probe = reads.where(R.eligible(min_mapq)).limit(most).agg(F.count("*").alias("n"), F.count_if(R.has(R.PAIRED)).alias("paired")).first()
    if not probe["n"]:
        raise ValueError("no eligible primary alignments")
    if require_paired and not probe["paired"]:
        raise ValueError("ndigenome needs paired-end reads")


MATE = ["mate_contig", "mate_start", "mate_reverse"]
#: What ``fixmate`` adds: the mate's place, strand, unclipped 5' end, quality and order.
FIXED = [*MATE, "mate_end", "mate_quality", "mate_ord"]


def _quality(reads: DataFrame) -> Column:
    """What fragments are ranked by: the sum of base qualities if reads have it, else the mapping quality."""
    return F.coalesce("quality_sum", F.col("mapping_quality")).cast("long") if "quality_sum" in reads.columns else F.col("mapping_quality").cast("long")


def fixmate(reads: DataFrame) -> DataFrame:
    """reads with FIXED, and the flags of the mate's strand and of a mate that isn't mapped set as it is.

    Templates meet by name: of each side (first, last) the primary record that comes first counts, so a template is a row of two structs, and however
    often a name repeats, no pairs are made. Secondary and supplementary records get the mate of their side. Reads that
    aren't paired, or whose mate isn't there or isn't mapped, have nulls.
    """
    found = F.struct(F.col("read_ord").alias("ord"), "contig", F.col("reference_start").alias("start"), R.has(R.REVERSE).alias("reverse"), R.has(R.UNMAPPED).alias("unmapped"), R.unclipped_end().alias("end"), _quality(reads).alias("quality"))
    primary = R.has(R.PAIRED) & ~R.has(R.SECONDARY | R.SUPPLEMENTARY)
    sides = {"_first": R.has(R.FIRST), "_last": R.has(R.LAST)}
    templates = reads.where(primary).groupBy("query_name").agg(*[F.min(F.when(s, found)).alias(n) for n, s in sides.items()])
    joined = reads.drop(*FIXED).join(templates, "query_name", "left")
    joined = joined.withColumn("_mate", F.when(R.has(R.PAIRED), F.when(R.has(R.FIRST), F.col("_last")).when(R.has(R.LAST), F.col("_first"))))
    mapped = F.col("_mate").isNotNull() & ~F.col("_mate.unmapped")
    fields = dict(zip(FIXED, ("contig", "start", "reverse", "end", "quality", "ord")))
    bits = F.when(mapped & F.col("_mate.reverse"), R.MATE_REVERSE).otherwise(0).bitwiseOR(F.when(F.col("_mate.unmapped"), R.MATE_UNMAPPED).otherwise(0))
    flag = F.when(F.col("_mate").isNull(), F.col("flag")).otherwise(F.col("flag").bitwiseAND(~(R.MATE_REVERSE | R.MATE_UNMAPPED)).bitwiseOR(bits))
    return joined.select(*[flag.cast("int").alias(c) if c == "flag" else F.col(c) for c in reads.columns if c not in FIXED], *[F.when(mapped, F.col(f"_mate.{f}")).alias(c) for c, f in fields.items()])


def mark_duplicates(reads: DataFrame) -> DataFrame:
    """Flags all but one of the fragments that begin alike.

    Only mapped primary records are compared, others keep their flags and stand in nobody's way. Alike: contig, strand,
    unclipped 5' end (all clips before it counted), being paired, and the mate's place as far as reads have the columns of MATE. The one that stays has the
    greatest ``quality_sum`` if reads have it, then mapping quality, then comes first.

    After ``fixmate`` whole pairs are compared: mates by their unclipped ends, qualities of both in sum, the order of whichever comes first, so
    that both mates of a pair stay or go. A read without a mapped mate that begins where a pair's read does is a duplicate of it.
    """
    alike = ["contig", R.strand(), R.unclipped_end()]
    whole = set(FIXED) <= set(reads.columns)
    if whole:
        own = Window.partitionBy(*alike)
        alike += ["mate_contig", "mate_end", "mate_reverse"]
        best = [(_quality(reads) + F.coalesce("mate_quality", F.lit(0))).desc(), F.least("read_ord", "mate_ord")]
    else:
        alike += [R.has(R.PAIRED), *[c for c in MATE if c in reads.columns]]
        best = [*[F.col(c).desc() for c in ("quality_sum", "mapping_quality") if c in reads.columns], "read_ord"]
    compared = ~R.has(R.UNMAPPED | R.SECONDARY | R.SUPPLEMENTARY)
    gone = F.row_number().over(Window.partitionBy(*alike).orderBy(*best)) > 1
    if whole:
        gone = gone | F.col("mate_end").isNull() & (F.count("mate_end").over(own) > 0)
    own = reads.where(compared).withColumn("flag", F.when(gone, F.col("flag").bitwiseOR(R.DUPLICATE)).otherwise(F.col("flag")))
    return own.unionByName(reads.where(~compared))
