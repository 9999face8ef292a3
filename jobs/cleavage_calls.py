"""Job 1, a batch: the cleavage calls of a sample, by both analyses, against its control, known variants and mask.

    python -m jobs.cleavage_calls --tables FOLDER --out FOLDER [--config FILE]

FOLDER of tables: lineitem and part (Parquet), of which reads, control reads, variants, mask and contigs are projections; or tables of these
names themselves (``reads``, ``contigs``, and ``control``, ``variants``, ``mask`` if there are such), where ``reads`` is there. Written under out:

    calls/analysis=A/sample=S/tier=T    the call tables (Parquet)
    bed/analysis=A/sample=S             passing calls, BED of six columns
    qc/analysis=A/sample=S              (kind, value, n): rows by tier, class and signal, and candidates (JSON lines)

A run replaces the folders of its own sample and analyses, whole, and touches no others: a rerun leaves the same rows, also where a
changed threshold leaves a tier empty, and after a run that broke off. An analysis is written when its calls are complete.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import LOG, command_line, config_of
from strandmark.operators import filters, sinks, sites
from strandmark.plans.calling import Inputs
from strandmark.plans.calling import calls as calls_of
from strandmark.plans.oracle import ORACLE_SQL
from strandmark.schema import Params
from strandmark.session import new_folder
from strandmark.sources import fixtures

CONFIG = Path(__file__).with_suffix(".json")
DEFAULTS = {"sample": "sample", "control_sample": "", "analyses": ["ndigenome"], "check_inputs": True, "thresholds": {}}
KEYS = ["analysis", "sample"]


def _there(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def inputs_of(spark: SparkSession, tables: str, controlled: bool) -> Inputs:
    if not _there(spark, f"{tables}/reads"):
        return Inputs(fixtures.reads(spark, tables), fixtures.contigs(spark, tables), fixtures.reads(spark, tables, "control") if controlled else None, fixtures.variants(spark, tables), fixtures.mask(spark, tables))
    optional = {name: spark.read.parquet(f"{tables}/{name}") if _there(spark, f"{tables}/{name}") else None for name in ("control", "variants", "mask")}
    if controlled and optional["control"] is None:
        raise ValueError(f"a control sample is named, but {tables}/control isn't there")
    return Inputs(spark.read.parquet(f"{tables}/reads"), spark.read.parquet(f"{tables}/contigs"), optional["control"] if controlled else None, optional["variants"], optional["mask"])


def run(spark: SparkSession, tables: str, out: str, config: dict | None = None) -> dict[str, int]:
    """Rows written, by analysis."""
    config = config_of(DEFAULTS, config)
    controlled = bool(config["control_sample"])
    inputs = inputs_of(spark, tables, controlled)
    for r in sites.contig_density(inputs.reads).orderBy("contig").collect():  # a row a contig
        LOG.info("read %s: %s has %d mapped reads", tables, r["contig"], r["mapped"])
    total = {}
    analyses = [Params(sample=config["sample"], control_sample=config["control_sample"], analysis=analysis, **config["thresholds"]) for analysis in config["analyses"]]
    for params, got in zip(analyses, calls_of(inputs, analyses, checks=config["check_inputs"])):
        analysis = params.analysis
        place = lambda what: f"{out}/{what}/analysis={analysis}/sample={params.sample}"  # noqa: B023, E731
        rows = got.table.withColumn("tier", filters.tier()).drop(*KEYS)
        rows.repartitionByRange("tier", "contig", "position_0based").sortWithinPartitions(*sinks.ORDER).write.mode("overwrite").partitionBy("tier").parquet(place("calls"))
        # what else is written comes from the calls as they stand
        table = spark.read.schema(rows.schema).parquet(place("calls")).withColumns({"analysis": F.lit(analysis), "sample": F.lit(params.sample)})
        sinks.bed(table).orderBy("contig", "start", "bed_strand").write.mode("overwrite").option("sep", "\t").csv(place("bed"))
        candidates = got.candidates.agg(F.lit("candidates").alias("kind"), F.lit("all").alias("value"), F.count("*").alias("n"))
        sinks.counts(table).unionByName(candidates).coalesce(1).write.mode("overwrite").json(place("qc"))
        by_tier = {r["tier"]: r["count"] for r in table.groupBy("tier").count().collect()}  # a row a tier
        total[analysis] = sum(by_tier.values())
        LOG.info("wrote %s: %d calls: %s", place("calls"), total[analysis], ", ".join(f"{n} {t}" for t, n in sorted(by_tier.items())))
    return total


def calls(spark: SparkSession, out: str) -> DataFrame:
    """All calls that are under out."""
    return spark.read.option("basePath", f"{out}/calls").parquet(f"{out}/calls")


def job1_cleavage_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run twice into one folder; all calls that are there then."""
    from jobs.common import read_config

    out = new_folder(spark, "job1", keep=True)
    for _ in range(2):
        run(spark, sf_dir, out, read_config(CONFIG))
    found = calls(spark, out)
    return found.select(*[F.round(f.name, 6).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in found.schema.fields])


_TIER = "CASE WHEN filter_status = 'PASS' THEN 'high_confidence' WHEN classification = 'ARTIFACT_RISK' THEN 'artifact' ELSE 'manual_review' END AS tier"
SQL = " UNION ALL BY NAME ".join(f"SELECT *, {_TIER} FROM ({ORACLE_SQL[name]})" for name in ("final_calls_ssb", "final_calls_dsb"))


if __name__ == "__main__":
    command_line("cleavage_calls", __doc__.split("\n")[0], CONFIG, {"tables": "folder of the input tables", "out": "folder of the output"}, lambda spark, given, config: run(spark, given.tables, given.out, config))
