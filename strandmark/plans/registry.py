"""Queries over the driver's tables, by name, and the same results as DuckDB SQL.

Reads, variants and the mask are projections of lineitem and part (strandmark.sources.fixtures).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmark.functions import reads as R
from strandmark.functions.statistics import benjamini_hochberg
from strandmark.operators import double_strand, evidence, filters, intervals, manifest, planner, single_strand, sinks, sites
from strandmark.plans import calling, chunks, local_chunks
from strandmark.plans.calling import Calls, Inputs, call
from strandmark.plans.oracle import ORACLE_SQL as ORACLE_SQL
from strandmark.schema import Params
from strandmark.session import by_rows, new_folder, written
from strandmark.sources import fixtures, formats
from strandmark.streaming import endpoints, ordered

SINGLE = Params(sample="treated", control_sample="control", ndigenome_min_count=4, ndigenome_opposite_window=2, ndigenome_ambiguous_min_count=2, control_min_fold=3.0)
DOUBLE = SINGLE.but(analysis="digenome", digenome_pair_window=3, digenome_forward_cutoff=2, digenome_reverse_cutoff=2, digenome_depth_cutoff=4, digenome_pair_score_cutoff=0.5)

#: Of a stream's arriving files, so that their number grows with the reads and no task sees a fixed share of all.
READS_A_FILE = 500_000

#: That a batch of the ordered stream takes at once, and a piece of work for as many tasks.
FILES_A_BATCH = 12


def _inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(fixtures.reads(spark, sf_dir), fixtures.contigs(spark, sf_dir), fixtures.reads(spark, sf_dir, "control"), fixtures.variants(spark, sf_dir), fixtures.mask(spark, sf_dir))


def _called(spark: SparkSession, sf_dir: str, params: Params) -> Calls:
    return call(_inputs(spark, sf_dir), params, checks=False)  # the tables' reads are single


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema.fields])


def eligible_reads(spark, d):
    return fixtures.reads(spark, d).where(R.eligible(1)).groupBy("contig", R.strand().alias("strand")).agg(F.count("*").alias("n"), F.sum("reference_start").alias("starts"), F.sum(R.five_prime_clip()).cast("long").alias("clipped"))


def read_endpoints(spark, d):
    return fixtures.reads(spark, d).where(R.eligible(1)).select("query_name", "contig", R.strand().alias("strand"), R.endpoint().alias("pos"))


def endpoint_pileups(spark, d):
    return sites.pileups(fixtures.reads(spark, d), 4, 1)


def site_depth_fraction(spark, d):
    r = fixtures.reads(spark, d)
    return _rounded(sites.depths(sites.pileups(r, 4, 1), r, 1))


def site_local_metrics(spark, d):
    r = fixtures.reads(spark, d)
    drop = ("indel_position", "indel_type", "indel_length")
    return _rounded(sites.metrics(sites.pileups(r, 4, 1), r, 10, 1).drop(*drop))


def modal_indel(spark, d):
    r = fixtures.reads(spark, d)
    return sites.metrics(sites.pileups(r, 4, 1), r, 10, 1).where("indel_position IS NOT NULL").select(*sites.SITE, "indel_position", "indel_type", "indel_length")


def opposite_best(spark, d):
    scanned, near = single_strand.scan(fixtures.reads(spark, d), SINGLE)
    return _rounded(single_strand.best_opposite(by_rows(written(single_strand.focal(scanned, near, SINGLE), "sites")), near, SINGLE))


def ssb_calls(spark, d):
    rows = single_strand.calls(fixtures.reads(spark, d), SINGLE)[1]
    return _rounded(rows.select("contig", "pos", "strand", "endpoint_count", "strand_depth", "opposite_position_0based", "opposite_count", "signal_classification", "digenome_pair_score"))


def pair_candidates(spark, d):
    pairs = double_strand.candidates(fixtures.reads(spark, d), DOUBLE, metrics=False)
    return _rounded(pairs.select(*double_strand.PAIR, "pair_score", F.array_join("caller_reasons", ";").alias("reasons")))


def pair_components(spark, d):
    pairs = double_strand.candidates(fixtures.reads(spark, d), DOUBLE, metrics=False)
    return double_strand.components(pairs.select(*double_strand.PAIR), 0)


def pair_matching(spark, d):
    pairs = by_rows(written(double_strand.candidates(fixtures.reads(spark, d), DOUBLE, metrics=False), "pairs"))
    return _rounded(double_strand.select_pairs(pairs, 0).select(*double_strand.PAIR, "pair_score"))


def rgen_score(spark, d):
    r = fixtures.reads(spark, d)
    forward = sites.pileups(r, 3, 1).where("strand = '+'").select("contig", F.col("pos").alias("forward_position"))
    return _rounded(double_strand.single_precision_score(forward, r, fixtures.contigs(spark, d), 0, 1))


def control_evidence(spark, d):
    rows = single_strand.calls(fixtures.reads(spark, d), SINGLE)[1]
    out = evidence.control(rows, fixtures.reads(spark, d, "control"), fixtures.contigs(spark, d), SINGLE)
    return _rounded(out.select("contig", "pos", "strand", "control_status", "control_endpoint_count", "control_depth", "control_fraction", "control_fold_enrichment", "control_fisher_p", "control_fisher_q"))


def q_values(spark, d):
    from strandmark.session import table

    p = table(spark, d, "orders").select("o_orderkey", ((F.floor("o_totalprice") % 1000) / 1000).alias("p"), (F.col("o_custkey") % 3).alias("g"))
    p = p.withColumn("p", F.when(F.col("o_orderkey") % 10 != 0, F.col("p")))
    return _rounded(benjamini_hochberg(p, "p", "q", ["g"], ["o_orderkey"]).select("o_orderkey", "g", "p", "q"))


def blacklist_merge(spark, d):
    return intervals.merge(fixtures.mask(spark, d))


def blacklist_totals(spark, d):
    return intervals.totals(intervals.merge(fixtures.mask(spark, d)))


def blacklist_subtract(spark, d):
    tiles = fixtures.contigs(spark, d).select("contig", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(1000).cast("long"))).alias("start"), "length")
    tiles = tiles.select("contig", "start", F.least(F.col("start") + 1000, F.col("length")).alias("end"))
    return intervals.subtract(tiles, intervals.merge(fixtures.mask(spark, d))).select("contig", "start", "end")


def masked_endpoints(spark, d):
    return sites.pileups(fixtures.reads(spark, d), 4, 1, intervals.merge(fixtures.mask(spark, d)))


def known_indel_overlap(spark, d):
    r = fixtures.reads(spark, d)
    points = sites.pileups(r, 4, 1).withColumn("opposite_position_0based", F.lit(None).cast("long"))
    return evidence.known_indels(points, fixtures.variants(spark, d), 10).where("known_indel_overlap <> ''").select(*sites.SITE, "known_indel_overlap")


def final_calls_ssb(spark, d):
    return _rounded(_called(spark, d, SINGLE).table)


def final_calls_dsb(spark, d):
    return _rounded(_called(spark, d, DOUBLE).table)


def tier_counts(spark, d):
    return _called(spark, d, SINGLE).table.groupBy(filters.tier().alias("tier"), "classification").agg(F.count("*").alias("n"))


def bed_rows(spark, d):
    return sinks.bed(_called(spark, d, SINGLE).table)


def qc_counts(spark, d):
    return sinks.multiqc(_called(spark, d, SINGLE).table)


def contig_density(spark, d):
    return sites.contig_density(fixtures.reads(spark, d))


def flagstat(spark, d):
    return sites.flagstat(fixtures.reads(spark, d))


def chunk_plan(spark, d):
    return planner.plan_frame(spark, planner.plan(sites.contig_density(fixtures.reads(spark, d)), fixtures.contigs(spark, d), 8, SINGLE.padding, fixtures.mask(spark, d)))


def _text(df: DataFrame, name: str) -> str:
    """The folder in which the lines (value) of df are written."""
    path = new_folder(df.sparkSession, name)
    df.write.text(path)
    return path


def sam_reads(spark, d):
    """Reads written as SAM text and read back."""
    r = fixtures.reads(spark, d)
    unmapped = R.has(R.UNMAPPED)
    tag = F.when(F.col("nm").isNotNull(), F.concat(F.lit("\tNM:i:"), F.col("nm").cast("string"))).otherwise("")
    fields = ["query_name", "flag", "contig", F.col("reference_start") + 1, "mapping_quality", F.when(unmapped, "*").otherwise(F.col("cigar")), F.lit("*"), F.lit(0), F.lit(0), F.lit("*"), F.lit("*")]
    line = F.concat(F.concat_ws("\t", *[(F.col(f) if isinstance(f, str) else f).cast("string") for f in fields]), tag)
    head = fixtures.contigs(spark, d).select(F.concat(F.lit("@SQ\tSN:"), "contig", F.lit("\tLN:"), F.col("length").cast("string")).alias("value"))
    path = _text(head.union(r.select(line.alias("value"))), "sam")
    formats.check_contigs(fixtures.contigs(spark, d), formats.sam_contigs(spark, path), "the header")
    return formats.sam(spark, path).drop("read_ord")


def region_reads(spark, d):
    """Reads of three regions, fetched from files by contig and range."""
    path = new_folder(spark, "stored")
    formats.store_reads(fixtures.reads(spark, d), path)
    stored = spark.read.parquet(path)
    some = [formats.region(stored, "chr1", 0, 1000), formats.region(stored, "chr2", 3000, 3001), formats.region(stored, "chr3", 5000, 1 << 40)]
    return some[0].union(some[1]).union(some[2]).select("contig", "query_name", "reference_start", "reference_end")


def sam_header(spark, d):
    head = fixtures.contigs(spark, d).orderBy("contig").coalesce(1).select(F.concat(F.lit("@SQ\tSN:"), "contig", F.lit("\tLN:"), F.col("length").cast("string")).alias("value"))
    path = _text(head, "header")
    formats.same_contigs(formats.sam_contigs(spark, path), formats.sam_contigs(spark, path))
    return formats.sam_contigs(spark, path).select("contig", "length")


def reads_probe(spark, d):
    """Of the reads that a layout probe looks at: whether there are any."""
    r = fixtures.reads(spark, d)
    sites.layout(r, 1, False)
    return r.where(R.eligible(1)).limit(10_000).agg((F.count("*") > 0).alias("found"), (F.count_if(R.has(R.PAIRED)) > 0).alias("paired"))


def vcf_variants(spark, d):
    v = fixtures.variants(spark, d)
    head = fixtures.contigs(spark, d).select(F.format_string("##contig=<ID=%s,length=%d>", "contig", "length").alias("value"))
    rows = v.select(F.concat_ws("\t", "contig", F.col("pos").cast("string"), F.lit("."), "ref", F.array_join("alts", ","), F.lit("."), F.lit("."), F.concat(F.lit("DP=3;END="), (F.col("pos") + 9).cast("string"))).alias("value"))
    found, declared = formats.vcf(spark, _text(head.union(rows), "vcf"))
    formats.check_contigs(fixtures.contigs(spark, d), declared, "the variants' header")
    return found.select("contig", "pos", "ref", F.array_join("alts", ",").alias("alt"), F.col("end").alias("last"))


def indel_spans(spark, d):
    """Labels and spans of the variants that change length, with their declared ends."""
    return evidence.indel_labels(fixtures.variants(spark, d).withColumn("end", F.when(F.col("pos") % 2 == 0, F.col("pos") + 30)))


def bed_mask(spark, d):
    text = fixtures.mask(spark, d).select(F.concat_ws("\t", "contig", F.col("start").cast("string"), F.col("end").cast("string"), F.lit("name")).alias("value"))
    notes = spark.createDataFrame([("# a comment",), ("track name=x",), ("browser position",), ("",)], "value string")
    return formats.bed(spark, _text(notes.union(text), "bed"), fixtures.contigs(spark, d))


def overlap_bases(spark, d):
    return intervals.overlap_bases(_tiles(spark, d, 1000), intervals.merge(fixtures.mask(spark, d)))


def coverage_faults(spark, d):
    """Tiles of which some are left out and some reach too far."""
    tiles = _tiles(spark, d, 500).where("start % 3500 <> 1000").withColumn("end", F.when(F.col("start") % 4000 == 2000, F.col("end") + 7).otherwise(F.col("end")))
    return intervals.coverage_faults(tiles, fixtures.contigs(spark, d)).select("contig", "at", "fault")


def interval_table(spark, d):
    """Owned intervals written and read as a table, and the sites that they own."""
    rows = _tiles(spark, d, 5000).where("start % 10000 = 0")
    text = rows.select(F.lit(1).alias("k"), F.concat_ws("\t", "contig", F.col("start").cast("string"), F.col("end").cast("string"), F.greatest(F.col("start") - 20, F.lit(0)).cast("string"), F.col("end").cast("string")).alias("value"))
    both = spark.createDataFrame([(0, "\t".join(formats.INTERVAL_COLUMNS))], "k int, value string").union(text)
    path = _text(both.coalesce(1).sortWithinPartitions("k").select("value"), "intervals")
    return formats.owned(sites.pileups(fixtures.reads(spark, d), 4, 1), formats.interval_table(spark, path, fixtures.contigs(spark, d)))


def _tiles(spark, d, size):
    tiles = fixtures.contigs(spark, d).select("contig", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))).alias("start"), "length")
    return tiles.select("contig", "start", F.least(F.col("start") + size, F.col("length")).alias("end"))


def fastq_reads(spark, d):
    """Two lanes of FASTQ text read as one, tails trimmed, filtered."""
    from strandmark.session import table

    o = table(spark, d, "orders")
    key = F.col("o_orderkey")
    body = F.when(key % 5 == 0, F.repeat(F.lit("A"), 60)).when(key % 5 == 1, F.repeat(F.lit("ACGT"), 15)).otherwise(F.repeat(F.lit("GATTACAC"), 8))
    seq = F.substring(body, F.lit(1), (24 + 8 * (key % 6)).cast("int"))
    qual = F.concat(F.repeat(F.lit("#"), (key % 7 * F.length(seq) / 10).cast("int")), F.repeat(F.lit("I"), 100))
    o = o.select(key.alias("k"), seq.alias("s"), F.substring(qual, F.lit(1), F.length(seq)).alias("q"))
    lanes = []
    for lane in (0, 1):
        own = o.where(F.col("k") % 2 == lane).orderBy("k").coalesce(1)
        lanes.append(_text(own.select(F.concat(F.lit("@r"), F.col("k").cast("string"), F.lit("\n"), "s", F.lit("\n+\n"), "q").alias("value")), f"lane{lane}"))
    return formats.passing_reads(formats.fastq(spark, lanes)).select("name", "seq", "qual")


def duplicates(spark, d):
    return sites.mark_duplicates(fixtures.reads(spark, d)).select("query_name", "reference_start", "flag")


def pair_duplicates(spark, d):
    """Mates found for each other, then duplicates among whole pairs and single reads."""
    marked = sites.mark_duplicates(sites.fixmate(fixtures.pairs(spark, d)))
    return marked.select("query_name", "read_ord", "flag", F.coalesce("mate_contig", F.lit("")).alias("mate_contig"), "mate_end")


def samplesheet(spark, d):
    """A sheet of suppliers as samples with one to three lanes, checked, numbered, sorted and written."""
    path = new_folder(spark, "sheet")
    manifest.write(_sheet(spark, d), path)
    return spark.read.option("header", True).csv(path).fillna("").select(*manifest.WRITTEN)


def _sheet(spark, d):
    from strandmark.session import table

    s = table(spark, d, "supplier").select("s_suppkey", F.explode(F.sequence(F.lit(1), (F.col("s_suppkey") % 3 + 1).cast("int"))).alias("lane"))
    name = F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))
    control = F.when((F.col("s_suppkey") > 7) & (F.col("s_suppkey") % 7 > 0), F.concat(F.lit("s"), (F.col("s_suppkey") % 7).cast("string"))).otherwise("")
    file = lambda k: F.format_string(f"/lanes/%s_%d_{k}.fq.gz", name, "lane")
    vcf = F.when(F.col("s_suppkey") % 5 == 0, F.concat(F.lit("/known/./"), name, F.lit(".vcf.gz"))).otherwise("")
    rows = s.select("s_suppkey", "lane", F.concat_ws(",", F.concat(F.lit(" "), name), file(1), file(2), control, vcf).alias("value"))
    text = spark.createDataFrame([(-1, 0, "sample,fastq_1, fastq_2,control,variant_vcf")], "s_suppkey long, lane int, value string").union(rows)
    path = _text(text.coalesce(1).sortWithinPartitions("s_suppkey", "lane").select("value"), "csv")
    return manifest.normalised(manifest.read(spark, path), "ndigenome", exists=lambda p: not p.endswith(".tbi"))


def lanes(spark, d):
    """Lanes of each sample, gathered."""
    return _sheet(spark, d).groupBy("sample").agg(F.count("*").alias("lanes"), F.array_join(F.array_sort(F.collect_list("lane")), ";").alias("names"), F.first("layout").alias("layout"))


def control_matching(spark, d):
    """Treated samples joined to their control (1 : n)."""
    rows = _sheet(spark, d)
    controls = rows.where("is_control = 'true'").select(F.col("sample").alias("control_sample")).distinct()
    return manifest.matched(rows).join(controls, "control_sample").groupBy("control_sample").agg(F.count("*").alias("treated"))


def chunk_table(spark, d):
    return planner.chunk_table(chunk_plan(spark, d).coalesce(1))


def chunked_calls(spark, d):
    """Calls by chunk: fragments and summaries written, read back, checked and finalised."""
    inputs, folder = _inputs(spark, d), new_folder(spark, "chunked")
    candidates, found = calling.rows(inputs, SINGLE)
    plan = planner.plan(sites.contig_density(inputs.reads), inputs.contigs, 4, SINGLE.padding, inputs.mask)
    chunks.write_chunks(found, candidates, plan, inputs.contigs, SINGLE, folder)
    return _rounded(chunks.finalised(spark, folder, SINGLE)[0])


def chunk_by_itself(spark, d):
    """Calls of chunks that look at the reads near them only, of reads stored by place: written, read back, checked, finalised."""
    inputs, folder, path = _inputs(spark, d), new_folder(spark, "local"), new_folder(spark, "stored")
    formats.store_reads(inputs.reads, path)
    inputs = replace(inputs, reads=spark.read.parquet(path))
    plan = planner.plan(sites.contig_density(inputs.reads), inputs.contigs, 2, DOUBLE.padding, inputs.mask)
    lengths = {r["contig"]: r["length"] for r in inputs.contigs.orderBy("contig").collect()}
    for chunk in dict.fromkeys(r["chunk_id"] for r in plan):
        rows = [r for r in plan if r["chunk_id"] == chunk]
        owned = [local_chunks.Interval(r["contig"], r["owner_start"], r["owner_end"], r["scan_start"], r["scan_end"]) for r in rows]
        candidates, found, _ = local_chunks.call(inputs, owned, DOUBLE)
        chunks.write_chunk(chunk, candidates, found, [(x.contig, x.start, x.end) for x in owned], DOUBLE, {c: n for c, n in lengths.items() if any(r["contig"] == c for r in plan)}, folder)
    return _rounded(chunks.finalised(spark, folder, DOUBLE)[0])


def chunk_totals(spark, d):
    """Rows and candidates that the chunks' summaries report, in sum."""
    inputs, folder = _inputs(spark, d), new_folder(spark, "totals")
    candidates, found = calling.rows(inputs, SINGLE)
    plan = planner.plan(sites.contig_density(inputs.reads), inputs.contigs, 3, SINGLE.padding)
    chunks.write_chunks(found, candidates, plan, inputs.contigs, SINGLE, folder)
    rows = [(s["reported_rows"], s["candidate_count"]) for s in chunks.summaries(spark, f"{folder}/summaries", SINGLE.sample, SINGLE.analysis)]
    return spark.createDataFrame(rows, "rows long, candidates long").agg(F.sum("rows").alias("rows"), F.sum("candidates").alias("candidates"))


def formatted_calls(spark, d):
    names = ["contig", "position_0based", "strand", "endpoint_fraction", "support_mean_mapq", "local_mean_mapq", "support_mean_nm", "digenome_pair_score", "rgen_digenome_score", "opposite_position_1based", "filter_reasons"]
    return sinks.formatted(_called(spark, d, SINGLE).table).select(*names)


def written_calls(spark, d):
    """The written tables, read back: all rows, and those of each tier."""
    folder = new_folder(spark, "written")
    got = _called(spark, d, SINGLE)
    sinks.write(got.table, 0, SINGLE, folder)
    read = lambda part: spark.read.option("sep", "\t").option("header", True).csv(f"{folder}/{part}")
    both = read("all").select("*", F.lit("all").alias("tier")).unionByName(read("calls"))
    return both.select("tier", "contig", F.col("position_0based").cast("long").alias("position_0based"), "strand", "classification", F.coalesce("filter_reasons", F.lit("")).alias("filter_reasons"))


def qc_document(spark, d):
    """The QC document's counts."""
    got = _called(spark, d, SINGLE)
    document = sinks.qc(written(got.table, "calls"), got.candidates.count(), SINGLE, {"intervals": 0})
    counted = {k: v for k, v in document.items() if isinstance(v, int) and k != "schema_version"} | {f"{k}_{c}": n for k in ("classifications", "signal_classifications") for c, n in document[k].items()}
    return spark.createDataFrame(sorted(counted.items()), "name string, n long")


def streamed_pileups(spark, d):
    """Pile-ups of reads that arrive as files of a stream."""
    folder = new_folder(spark, "stream")
    fixtures.reads(spark, d).write.option("maxRecordsPerFile", READS_A_FILE).parquet(f"{folder}/in")
    endpoints.run(endpoints.endpoint_counts(spark, f"{folder}/in", 1), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return endpoints.current(spark, f"{folder}/out", 4)


def ordered_pileups(spark, d):
    """Pile-ups of reads that arrive in coordinate order, as files of a bounded number of reads, given out once a later read has passed them."""
    folder = new_folder(spark, "ordered")
    reads, contigs = fixtures.reads(spark, d), [r["contig"] for r in fixtures.contigs(spark, d).collect()]  # a row a contig
    order = ["contig", "reference_start", "read_ord"]
    ranges = reads.count() // READS_A_FILE + 1
    reads.repartitionByRange(ranges, *order).sortWithinPartitions(*order).write.option("maxRecordsPerFile", READS_A_FILE).parquet(f"{folder}/in")
    ordered.in_turn(spark, f"{folder}/in")
    ordered.ended(spark, contigs).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    ordered.run(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", files=FILES_A_BATCH, partitions=len(contigs)).awaitTermination()
    return ordered.final(spark, f"{folder}/out", 4)


_NAMES = (
    "eligible_reads read_endpoints endpoint_pileups site_depth_fraction site_local_metrics modal_indel opposite_best ssb_calls pair_candidates pair_components pair_matching rgen_score control_evidence q_values blacklist_merge blacklist_totals blacklist_subtract masked_endpoints known_indel_overlap final_calls_ssb final_calls_dsb tier_counts bed_rows qc_counts contig_density flagstat chunk_plan control_matching "
    "sam_reads region_reads sam_header reads_probe vcf_variants indel_spans bed_mask overlap_bases coverage_faults interval_table fastq_reads duplicates pair_duplicates samplesheet lanes chunk_table chunked_calls chunk_by_itself chunk_totals formatted_calls written_calls qc_document streamed_pileups ordered_pileups"
).split()
QUERIES = {name: globals()[name] for name in _NAMES}
