"""Written results: tables by tier, BED, QC document, report table, value formatting."""

from __future__ import annotations

import json
from dataclasses import asdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strandmark.operators.filters import tier
from strandmark.schema import CALL_COLUMNS, FLOAT_COLUMNS, Params
from strandmark.session import written
from strandmark.sources.formats import unique_calls

CLASSES = ["SSB", "POSSIBLE_DSB", "AMBIGUOUS", "DSB", "ARTIFACT_RISK"]
TIERS = ["high_confidence", "manual_review", "artifact"]
ORDER = ["contig", "position_0based", "strand"]
QC_VERSION = 6


@F.pandas_udf(StringType())
def eight_digits(values: pd.Series) -> pd.Series:
    """%.8g, which the JVM's formatter writes with trailing zeros; null is empty."""
    return values.map("{:.8g}".format).where(values.notna(), "")


def formatted(table: DataFrame) -> DataFrame:
    """All columns as text: null is empty, floats have eight significant digits without trailing zeros."""
    return table.select(*[(eight_digits(c) if c in FLOAT_COLUMNS else F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in CALL_COLUMNS])


def bed(table: DataFrame) -> DataFrame:
    """PASS rows; the score is a thousandth of the fraction, rounded half to even."""
    name = F.concat_ws("|", "sample", "strand", "classification")
    score = F.least(F.lit(1000), F.rint(F.col("endpoint_fraction") * 1000).cast("int"))
    strand = F.when(F.col("strand").isin("+", "-"), F.col("strand")).otherwise(".")
    return table.where("filter_status = 'PASS'").select("contig", F.col("position_0based").alias("start"), (F.col("position_0based") + 1).alias("end"), name.alias("name"), score.alias("score"), strand.alias("bed_strand"))


def multiqc(table: DataFrame) -> DataFrame:
    """One row of counts by class."""
    return table.agg(F.count("*").alias("total"), F.count_if(F.col("filter_status") == "PASS").alias("passed"), *[F.count_if(F.col("classification") == c).alias(c.lower()) for c in CLASSES])


def counts(table: DataFrame) -> DataFrame:
    """(kind, value, n): rows by tier, classification and signal, and all of them; one pass."""
    kinds = {"tier": tier(), "classification": F.col("classification"), "signal": F.col("signal_classification"), "reported": F.lit("all")}
    one = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("value")) for k, c in kinds.items()]))
    return table.select(one.alias("x")).groupBy("x.kind", "x.value").agg(F.count("*").alias("n"))


def qc(table: DataFrame, candidates: int, params: Params, mask: dict | None = None) -> dict:
    """The QC document. mask: path, sha256, intervals and excluded_bases of the interval mask that was used."""
    found: dict[str, dict[str, int]] = {k: {} for k in ("tier", "classification", "signal", "reported")}
    for r in counts(table).collect():  # a row a class
        found[r["kind"]][r["value"]] = r["n"]
    tiers = {t: found["tier"].get(t, 0) for t in TIERS}
    several = ["Reads with several placements count at their primary one only; support may be spread over equal copies of the reference."]
    return {
        "schema_version": QC_VERSION,
        "sample": params.sample,
        "analysis": params.analysis,
        "control_status": "MATCHED_CONTROL" if params.control_sample else "UNCONTROLLED",
        "coordinate_convention": {"internal": "0-based 5' end of the alignment", "tsv": "0-based and 1-based columns", "bed": "0-based half-open"},
        "alignment_counting": {"keep_multimappers": params.keep_multimappers, "primary_alignments": "once, at the primary placement", "secondary_and_supplementary_alignments": "diagnostic only"},
        "genome_blacklist": {"enabled": mask is not None, "path": "", "sha256": "", "intervals": 0, "excluded_bases": 0} | (mask or {}),
        "warnings": several if params.keep_multimappers else [],
        "parameters": asdict(params),
        "candidate_endpoints_or_pairs_before_filters": candidates,
        "reported_candidates": found["reported"].get("all", 0),
        "high_confidence_calls": tiers["high_confidence"],
        "manual_review_candidates": tiers["manual_review"],
        "artifact_candidates": tiers["artifact"],
        "high_confidence_ssb": tiers["high_confidence"] if params.analysis == "ndigenome" else 0,
        "high_confidence_dsb": tiers["high_confidence"] if params.analysis == "digenome" else 0,
        "classifications": found["classification"],
        "signal_classifications": found["signal"],
    }


def report(document: dict) -> list[str]:
    """The lines of the report's table of one sample."""
    signals = document["signal_classifications"]
    row = {
        "Reported candidates": document["reported_candidates"], "High-confidence calls": document["high_confidence_calls"], "Manual-review candidates": document["manual_review_candidates"], "Artifact candidates": document["artifact_candidates"],
        "DSB": signals.get("DSB", 0), "SSB": signals.get("SSB", 0), "Possible DSB": signals.get("POSSIBLE_DSB", 0), "Ambiguous": signals.get("AMBIGUOUS", 0),
    }
    name = document["analysis"]
    comments = [f"# id: {name}_summary", f"# section_name: {name} cleavage summary", "# description: Cleavage endpoint calls by strand", "# plot_type: table"]
    return [*comments, "\t".join(["Sample", *row]), "\t".join([document["sample"], *map(str, row.values())])]


def _text(spark, lines: list[str], path: str) -> None:
    spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k long, value string").coalesce(1).sortWithinPartitions("k").select("value").write.text(path)


def write(table: DataFrame, candidates: int, params: Params, folder: str, mask: dict | None = None) -> dict:
    """Tables, BED, QC and report under folder, sorted by contig, position and strand; returns the QC document.

    ``all`` has every row, ``calls`` is partitioned by tier. Both are range-sorted over as many files as there are partitions: a
    cluster writes them in parallel, and the files' names are in the rows' order. The plan of the calls runs once.
    """
    spark = table.sparkSession
    table = unique_calls(written(table, "calls"))
    ordered = written(formatted(table.orderBy(*ORDER)).withColumn("tier", tier()), "formatted")
    options = {"sep": "\t", "header": True, "emptyValue": ""}
    position = F.col("position_0based").cast("long")
    ordered = ordered.orderBy("contig", position, "strand")
    ordered.drop("tier").write.options(**options).csv(f"{folder}/all")
    ordered.write.partitionBy("tier").options(**options).csv(f"{folder}/calls")
    bed(table).orderBy("contig", "start", "bed_strand").write.option("sep", "\t").csv(f"{folder}/bed")
    document = qc(table, candidates, params, mask)
    _text(spark, [json.dumps(document, sort_keys=True)], f"{folder}/qc")
    _text(spark, report(document), f"{folder}/report")
    return document
