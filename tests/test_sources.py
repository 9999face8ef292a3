import gzip
import json

import pytest
from util import forward, frame

from strandmark.operators import evidence, manifest, parameters, planner, runinfo, sites
from strandmark.schema import Params
from strandmark.sources import formats
from strandmark.streaming import endpoints


@pytest.fixture(scope="module")
def contigs(spark):
    return spark.createDataFrame([("chr1", 1000), ("chr2", 500)], "contig string, length long")


def put(path, text):
    path.write_text(text)
    return str(path)


def test_sam(spark, tmp_path):
    path = put(tmp_path / "a.sam", "@SQ\tSN:chr1\tLN:1000\n" + "r1\t16\tchr1\t101\t60\t5M2D5M\t*\t0\t0\tACGTACGTAC\t*\tNM:i:3\n" + "r2\t4\t*\t0\t0\t*\t*\t0\t0\tA\t*\n")
    rows = formats.sam(spark, path).collect()
    assert (rows[0].reference_start, rows[0].reference_end, rows[0].nm, rows[1].nm) == (100, 112, 3, None)
    assert tuple(formats.sam_contigs(spark, path).first())[:2] == ("chr1", 1000)


def test_regions_of_stored_reads(spark, tmp_path):
    rows = frame(spark, [r for k in range(0, 5000, 50) for r in forward(1, k)] + forward(2, 70, contig="chr2"))
    formats.store_reads(rows, str(tmp_path / "reads"))
    stored = spark.read.parquet(str(tmp_path / "reads"))
    some = formats.region(stored, "chr1", 100, 149)
    assert sorted(r.reference_start for r in some.collect()) == [100] and formats.region(stored, "chr2", 119, 120).count() == 2
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = formats.region(stored, "chr1", 100, 149)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(contig" in plan and "LessThan(reference_start,149)" in plan and "GreaterThan(reference_end,100)" in plan


def test_bed(spark, tmp_path, contigs):
    path = tmp_path / "m.bed.gz"
    path.write_bytes(gzip.compress(b"# x\ntrack a\nchr1 10 20 name\n\nchr2\t0\t500\n"))
    assert formats.bed(spark, str(path), contigs).count() == 2
    for bad in ("chr1 20 10\n", "chr9 1 2\n", "chr2 1 501\n", "chr1 a 2\n", "# only\n"):
        with pytest.raises(ValueError):
            formats.bed(spark, put(tmp_path / "bad.bed", bad), contigs)


def test_vcf(spark, tmp_path, contigs):
    path = put(tmp_path / "v.vcf", "##contig=<ID=chr1,length=1000>\n#CHROM\n" + "chr1\t5\t.\tAA\tA,T\t.\n")
    rows, declared = formats.vcf(spark, path)
    assert tuple(rows.first()) == ("chr1", 5, "AA", ["A", "T"], None)
    symbolic, _ = formats.vcf(spark, put(tmp_path / "s.vcf", "##contig=<ID=chr1,length=1000>\n#CHROM\nchr1\t100\t.\tA\t<DEL>\t.\t.\tSVTYPE=DEL;END=200\nchr1\t9\t.\tA\tG\n"))
    assert [tuple(r) for r in evidence.indel_labels(symbolic).collect()] == [("chr1", 99, 200, "chr1:100:A><DEL>")]
    formats.check_contigs(contigs.where("contig = 'chr1'"), declared, "variants")
    with pytest.raises(ValueError, match="chr2"):
        formats.check_contigs(contigs, declared, "variants")


def test_interval_table(spark, tmp_path, contigs):
    head = "contig\towner_start\towner_end\tscan_start\tscan_end\n"
    table = formats.interval_table(spark, put(tmp_path / "i.tsv", head + "chr1\t0\t500\t0\t510\nchr1\t500\t1000\t490\t1000\n"), contigs)
    points = spark.createDataFrame([("chr1", 499), ("chr2", 5)], "contig string, pos long")
    assert [tuple(r) for r in formats.owned(points, table).collect()] == [("chr1", 499)]
    for bad in ("chr1\t0\t500\t1\t510\n", "chr1\t0\t500\t0\t500\nchr1\t400\t600\t400\t600\n", "chr2\t0\t500\t0\t501\n"):
        with pytest.raises(ValueError):
            formats.interval_table(spark, put(tmp_path / "b.tsv", head + bad), contigs)


def test_fastq(spark, tmp_path):
    path = put(tmp_path / "a.fastq", "@a\nACGTACGTAC\n+\nIIIIIIIIII\n@b\nAAAAAAAAAA\n+\nIIIIIIIIII\n@c\nACGTACGTAC\n+\n!!!!!!!!!!\n")
    rows = formats.fastq(spark, [path])
    assert rows.count() == 3
    assert [r.name for r in formats.passing_reads(rows, length=10).collect()] == ["a"]


def sheet(tmp_path, *rows, head="sample,fastq_1,fastq_2,control"):
    return put(tmp_path / "s.csv", "\n".join([head, *rows]) + "\n")


def test_samplesheet(spark, tmp_path):
    path = sheet(tmp_path, "t,/x/t_1.fq.gz,/x/t_2.fq.gz,c", "c,/x/c_1.fq.gz,/x/c_2.fq.gz,", "t,/x/y/../u_1.fq.gz,/x/u_2.fq.gz,c")
    rows = manifest.normalised(manifest.read(spark, path), "ndigenome")
    got = rows.collect()
    assert [(r.sample, r.lane, r.is_control) for r in got] == [("c", "L001", "true"), ("t", "L001", "false"), ("t", "L002", "false")]
    assert got[2].fastq_1 == "/x/u_1.fq.gz" and {r.layout for r in got} == {"PE"}
    assert [tuple(r) for r in manifest.matched(rows).collect()] == [("t", "c")]
    manifest.write(rows, str(tmp_path / "out"))
    lines = spark.read.text(str(tmp_path / "out")).collect()
    assert [r.value for r in lines][:2] == [",".join(manifest.WRITTEN), "c,L001,/x/c_1.fq.gz,/x/c_2.fq.gz,,,,true"]


def test_samplesheet_files(spark, tmp_path):
    for name in ("a_1.fq.gz", "v.vcf.gz", "v.vcf.gz.csi", "w.vcf.gz"):
        put(tmp_path / name, "")
    (tmp_path / "link_1.fq.gz").symlink_to(tmp_path / "a_1.fq.gz")
    exists = lambda p: (tmp_path / p).exists()
    resolve = lambda p: str((tmp_path / p).resolve())
    head = "sample,fastq_1,fastq_2,variant_vcf"
    got = manifest.normalised(manifest.read(spark, sheet(tmp_path, "a,a_1.fq.gz,,v.vcf.gz", head=head)), "digenome", exists, resolve).collect()
    assert got[0].variant_index == str(tmp_path / "v.vcf.gz.csi") and got[0].variant_vcf == str(tmp_path / "v.vcf.gz") and got[0].layout == "SE"
    for row, message in (("a,a_1.fq.gz,,w.vcf.gz", "no index"), ("a,b_1.fq.gz,,", "no such file: b_1"), ("a,a_1.fq.gz,,\nb,link_1.fq.gz,,", "twice")):
        with pytest.raises(ValueError, match=message):
            manifest.normalised(manifest.read(spark, sheet(tmp_path, row, head=head)), "digenome", exists, resolve)


def test_samplesheet_names_clash_within_a_sample_only(spark, tmp_path):
    path = sheet(tmp_path, "a,d/x_1.fq.gz,d/x_2.fq.gz,", "b,e/x_1.fq.gz,e/x_2.fq.gz,")
    assert manifest.normalised(manifest.read(spark, path), "ndigenome").count() == 2
    with pytest.raises(ValueError, match="one name"):
        manifest.normalised(manifest.read(spark, sheet(tmp_path, "a,d/x_1.fq.gz,d/x_2.fq.gz,", "a,e/x_1.fq.gz,e/y_2.fq.gz,")), "ndigenome")


def test_samplesheet_lanes(spark, tmp_path):
    head = "sample,fastq_1,fastq_2,lane"
    rows = manifest.normalised(manifest.read(spark, sheet(tmp_path, "a,x_1.fq.gz,x_2.fq.gz,L7", "a,y_1.fq.gz,y_2.fq.gz,L3", head=head)), "digenome").collect()
    assert [r.lane for r in rows] == ["L3", "L7"]
    for row, message in (("a,x_1.fq.gz,x_2.fq.gz,", "blank lane"), ("a,x_1.fq.gz,x_2.fq.gz,L1\na,y_1.fq.gz,y_2.fq.gz,L1", "repeat")):
        with pytest.raises(ValueError, match=message):
            manifest.normalised(manifest.read(spark, sheet(tmp_path, row, head=head)), "digenome")


@pytest.mark.parametrize(
    "row, message",
    [
        ("a b,x_1.fq.gz,x_2.fq.gz,", "characters"),
        (",x_1.fq.gz,x_2.fq.gz,", "blank sample"),
        ("a,,x_2.fq.gz,", "blank fastq_1"),
        ("a,x.txt,x_2.fq.gz,", "fastq_1"),
        ("a,x_1.fq.gz,,", "paired"),
        ("a,x_1.fq.gz,x_1.fq.gz,", "twice"),
        ("a,x_1.fq.gz,./x_1.fq.gz,", "twice"),
        ("a,d/x.fq.gz,e/x.fq.gz,", "one name"),
        ("a,x_1.fq.gz,x_2.fq.gz,a", "own control"),
        ("a,x_1.fq.gz,x_2.fq.gz,zz", "no such control"),
        ("a,x_1.fq.gz,x_2.fq.gz,b\nb,y_1.fq.gz,y_2.fq.gz,c\nc,z_1.fq.gz,z_2.fq.gz,", "has a control"),
        ("a,x_1.fq.gz,x_2.fq.gz,b\na,y_1.fq.gz,y_2.fq.gz,\nb,z_1.fq.gz,z_2.fq.gz,", "different controls"),
    ],
)
def test_samplesheet_faults(spark, tmp_path, row, message):
    with pytest.raises(ValueError, match=message):
        manifest.normalised(manifest.read(spark, sheet(tmp_path, row)), "ndigenome")


def test_samplesheet_header(spark, tmp_path):
    for head in ("sample,fastq_1", "sample,fastq_1,fastq_2,other", "sample,fastq_1,fastq_2,lane, lane"):
        with pytest.raises(ValueError):
            manifest.read(spark, sheet(tmp_path, "a,b,c,d,e"[: 2 * len(head.split(",")) - 1], head=head))
    with pytest.raises(ValueError, match="no rows"):
        manifest.normalised(manifest.read(spark, sheet(tmp_path)), "digenome")


def test_parameters():
    schema = {"properties": {"n": {"type": "integer", "minimum": 1}, "x": {"type": ["number", "null"], "maximum": 1}, "m": {"enum": ["a"]}, "l": {"type": "array", "items": {"type": "string", "minLength": 2}}}, "required": ["n"], "additionalProperties": False}
    parameters.check({"n": 1, "x": 0.5, "m": "a", "l": ["ab"]}, schema)
    for bad in ({}, {"n": True}, {"n": 0}, {"n": 1, "x": 2}, {"n": 1, "m": "b"}, {"n": 1, "l": ["a"]}, {"n": 1, "zz": 1}):
        with pytest.raises(ValueError):
            parameters.check(bad, schema)
    with pytest.raises(ValueError, match="entries"):
        parameters.check({"n": 1, "o": {}}, schema | {"properties": schema["properties"] | {"o": {"type": "object", "minProperties": 1}}})
    genomes = {"hg38": {"aliases": ["GRCh38"]}, "mm10": {"aliases": ["grch38"]}}
    assert parameters.resolve_genome("HG38", genomes) == "hg38" and parameters.alias_clashes(genomes)
    with pytest.raises(ValueError):
        parameters.resolve_genome("grch38", genomes)
    with pytest.raises(ValueError):
        Params(ndigenome_min_fraction=1.5)


THREE = [("chr1", 2000, 0), ("chr2", 2000, 1), ("chr10", 2000, 2)]


def planned(spark, mapped, chunks, padding=0, mask=None):
    contigs = spark.createDataFrame(THREE, "contig string, length long, ordinal long")
    density = spark.createDataFrame(mapped, "contig string, mapped long")
    hidden = mask and spark.createDataFrame(mask, "contig string, start long, end long")
    return planner.plan(density, contigs, chunks, padding, hidden)


def spans(rows):
    return [(r["chunk_id"][-3:], r["contig"], r["owner_start"], r["owner_end"]) for r in rows]


def test_preflight_and_run_info(tmp_path):
    for name in ("s.csv", "g.fa"):
        put(tmp_path / name, "x")
    schema = {"properties": {"input": {"type": "string"}, "genome": {"type": "string"}, "genomes": {"type": "object", "minProperties": 1}, "containers": {"type": "object"}}, "required": ["input"], "additionalProperties": False}
    paths = {"input": str(tmp_path / "s.csv"), "fasta": str(tmp_path / "g.fa"), "genome_blacklist": "", "outdir": str(tmp_path / "new/out"), "ref_cache": str(tmp_path)}
    given = {"input": "s.csv", "genome": "hg38", "genomes": {"hg38": {}}, "containers": {"a": "docker://x"}}
    ready = runinfo.preflight({"parameters": given, "paths": paths}, schema)
    assert ready["status"] == "PASS" and len(ready["parameters_sha256"]) == 64 and ready["resolved_paths"] == paths
    bad = [
        (given | {"genome": " "}, paths, "genome is required"), (given, paths | {"fasta": "/none.fa"}, "fasta can't be read"), (given | {"zz": 1}, paths, "zz is unknown"), (given, {k: v for k, v in paths.items() if k != "outdir"}, "path outdir"),
        (given | {"containers": {"a": "./none.sif"}}, paths, "container a"), (given | {"genomes": {}}, paths, "entries"), (given, paths | {"outdir": str(tmp_path / "g.fa/out")}, "can't be made"), (given | {"genomes": {"a": {"aliases": ["x"]}, "b": {"aliases": ["X"]}}}, paths, "x: a, b"),
    ]
    for parameters_, paths_, message in bad:
        with pytest.raises(ValueError, match=message):
            runinfo.preflight({"parameters": parameters_, "paths": paths_}, schema)
    info = runinfo.run_info(Params(keep_multimappers=True), ready, 8, "hg38", containers={"a": tmp_path})
    assert info["ndigenome"]["min_mapq"] == 0 and len(info["automatic_overrides"]) == 3 and info["cleavage"]["chunks"] == 8 and info["containers"] == {"a": str(tmp_path)}
    assert json.loads(runinfo.document_text(info)) == info
    with pytest.raises(ValueError):
        runinfo.run_info(Params(), {"status": "FAIL"}, 8)
    assert runinfo.absolute("a/../b", "/x") == "/x/b" and runinfo.absolute("s3://a/b") == "s3://a/b" and runinfo.resolved_container("img.sif", "/x") == "/x/img.sif" and runinfo.quoted("a b") == "'a b'"


def test_plan_balances_open_records(spark, tmp_path):
    rows = planned(spark, [("chr1", 100), ("chr2", 100)], 2, 0, [("chr1", 0, 1800)])
    assert spans(rows) == [("000", "chr1", 0, 2000), ("000", "chr2", 0, 900), ("001", "chr2", 900, 2000)]
    assert [(r["mapped_records"], r["callable_mapped_records"]) for r in rows] == [(145, 55), (145, 55), (55, 55)]
    planner.write_plan(spark, rows, str(tmp_path))
    table = spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "plan")).collect()
    assert [(r.chunk_id, r.interval_count, r.contig_count, r.owned_bases, r.callable_bases, r.excluded_bases, r.intervals) for r in table] == [
        ("chunk_000", "2", "2", "2900", "1100", "1800", "chr1:0-2000,chr2:0-900"), ("chunk_001", "1", "1", "1100", "1100", "0", "chr2:900-2000")
    ]
    one = formats.interval_table(spark, str(tmp_path / "intervals/chunk_id=chunk_000"))
    assert sorted(tuple(r)[:3] for r in one.collect()) == [("chr1", 0, 2000), ("chr2", 0, 900)]


def test_plan_keeps_a_contig_that_is_hidden_whole(spark):
    rows = planned(spark, [("chr1", 10)], 8, 0, [("chr1", 0, 2000)])
    assert spans(rows) == [("000", "chr1", 0, 2000)]
    assert [rows[0][k] for k in ("mapped_records", "callable_mapped_records", "callable_bases", "excluded_bases")] == [10, 0, 0, 2000]


def test_plan_follows_the_header_and_covers_all(spark):
    rows = planned(spark, [("chr10", 3), ("chr2", 5), ("chr1", 8)], 2, 10)
    assert [r["contig"] for r in rows] == ["chr1", "chr2", "chr10"] and [r["chunk_id"] for r in rows] == ["chunk_000", "chunk_001", "chunk_001"]
    assert all(r["scan_start"] == 0 and r["scan_end"] == 2000 for r in rows)
    many = planned(spark, [("chr1", 8), ("chr2", 5), ("chr10", 3)], 20, 10)
    assert len({r["chunk_id"] for r in many}) <= 16
    for c in ("chr1", "chr2", "chr10"):
        own = [(r["owner_start"], r["owner_end"]) for r in many if r["contig"] == c]
        assert own[0][0] == 0 and own[-1][1] == 2000 and all(a[1] == b[0] for a, b in zip(own, own[1:]))
    masked = planned(spark, [("chr1", 8)], 2, 10, [("chr1", 100, 200)])
    assert sum(r["excluded_bases"] for r in masked) == 100
    # cuts that would fall together are moved apart, and stay within the contig
    tight = planned(spark, [("chr1", 50)], 8, 0, [("chr1", 3, 1999)])
    assert all(a["owner_end"] == b["owner_start"] and a["owner_start"] < a["owner_end"] for a, b in zip(tight, tight[1:])) and tight[-1]["owner_end"] == 2000
    with pytest.raises(ValueError, match="no mapped"):
        planned(spark, [("chr1", 0)], 2)


def test_duplicates(spark):
    rows = forward(3, 100) + forward(1, 300)
    df = frame(spark, rows)
    first = df.where("reference_start = 100").first().asDict()
    extra = [
        first | {"read_ord": 900, "query_name": "secondary", "flag": 257, "mapping_quality": 60},
        first | {"read_ord": 901, "query_name": "clipped", "flag": 1, "reference_start": 105, "cigar": "5S45M", "mapping_quality": 61},
        first | {"read_ord": 902, "query_name": "unmapped", "flag": 5},
    ]
    marked = {r.query_name: r.flag for r in sites.mark_duplicates(df.union(spark.createDataFrame(extra, df.schema))).collect()}
    own = {r.query_name for r in df.where("reference_start = 100").collect()}
    assert marked["clipped"] == 1 and all(marked[n] & 1024 for n in own) and marked["secondary"] == 257 and marked["unmapped"] == 5
    assert all(not marked[r.query_name] & 1024 for r in df.where("reference_start = 300").collect())


def test_fragments_and_stream(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f/a.jsonl.gz").write_bytes(gzip.compress(json.dumps({"contig": "chr1", "position_0based": 5, "strand": "+"}).encode()))
    calls = formats.fragments(spark, str(tmp_path / "f"), "contig string, position_0based long, strand string")
    assert formats.unique_calls(calls).count() == 1
    with pytest.raises(ValueError):
        formats.unique_calls(calls.union(calls))
    rows = frame(spark, forward(6, 100) + forward(2, 200))
    more = frame(spark, forward(3, 200) + forward(1, 300))
    where = [str(tmp_path / x) for x in ("reads", "piles", "checkpoint", "small")]
    for part in (rows, more):
        part.write.mode("append").parquet(where[0])
        endpoints.run(endpoints.endpoint_counts(spark, where[0], 1), where[1], where[2]).awaitTermination(120)
    want = sorted(tuple(r) for r in sites.pileups(rows.union(more), 5, 1).collect())
    assert sorted(tuple(r) for r in endpoints.current(spark, where[1], 5).collect()) == want and len(want) == 2
    # what the second batch didn't touch isn't written again
    assert spark.read.parquet(where[1]).count() == 4
    endpoints.compact(spark, where[1], where[3])
    assert sorted(tuple(r) for r in endpoints.current(spark, where[3], 5).collect()) == want


def test_shared_folder_and_discarded_tables(spark, tmp_path):
    import pathlib
    from types import SimpleNamespace

    from strandmark import session

    table = session.written(spark.range(5), "five")
    place = pathlib.Path(table._written_to.removeprefix("file://"))
    assert table.count() == 5 and place.exists()
    session.discard(table, spark.range(1))
    assert not place.exists()

    def cluster(master, folder):
        none = SimpleNamespace(getOrElse=lambda x: x)
        return SimpleNamespace(sparkContext=SimpleNamespace(master=master, getConf=lambda: {"spark.checkpoint.dir": folder} if folder else {}, setCheckpointDir=lambda x: None, _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: none))))

    assert session.shared_dir(cluster("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert session.shared_dir(cluster("local[4]", None)).startswith("file://")
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError, match="checkpoint.dir"):
            session.shared_dir(cluster(master, None))


def test_digests_and_documents(spark, tmp_path):
    import hashlib

    path = put(tmp_path / "g.fa", ">chr1\nACGT\n")
    assert formats.sha256(spark, path) == hashlib.sha256(b">chr1\nACGT\n").hexdigest()
    (tmp_path / "docs").mkdir()
    for k in range(3):
        put(tmp_path / f"docs/{k}.json", json.dumps({"chunk_id": f"c{k}", "intervals": [{"contig": "chr1", "start": k}], "reported_rows": k}, indent=2))
    got = formats.summaries(spark, str(tmp_path / "docs"))
    assert sorted((r.chunk_id, r.reported_rows, r.intervals[0].start) for r in got.collect()) == [("c0", 0, 0), ("c1", 1, 1), ("c2", 2, 2)]
    lines = [{"_chunk_id": "c0", "position_0based": 5}, {"_chunk_id": "c1", "position_0based": 6}]
    (tmp_path / "rows").mkdir()
    (tmp_path / "rows/a.jsonl.gz").write_bytes(gzip.compress("\n".join(map(json.dumps, lines)).encode()))
    assert formats.fragments(spark, str(tmp_path / "rows")).count() == 2
