"""Filter reasons, classification, tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmark.schema import CALL_COLUMNS, Params


def artifact_reasons(params: Params) -> Column:
    matched = F.col("control_status") == "MATCHED_CONTROL"
    tests = [
        (F.col("softclip_fraction") >= params.max_softclip_fraction, "HIGH_5P_SOFTCLIP"),
        (F.col("indel_fraction") >= params.max_indel_fraction, "NEARBY_INDEL"),
        (F.col("known_indel_overlap") != "", "KNOWN_INDEL"),
        (F.col("support_mean_mapq") < params.min_support_mean_mapq, "LOW_SUPPORT_MAPQ"),
        (F.col("control_status") == "INSUFFICIENT_CONTROL_COVERAGE", "INSUFFICIENT_CONTROL_COVERAGE"),
        (matched & (F.col("control_fraction") > params.control_max_fraction), "HIGH_CONTROL_FRACTION"),
        (matched & (F.col("control_fold_enrichment") < params.control_min_fold), "LOW_CONTROL_FOLD"),
        (matched & (F.col("control_fisher_q") > params.control_max_q), "CONTROL_Q_FAIL"),
    ]
    return F.array_compact(F.array(*[F.when(t, F.lit(name)) for t, name in tests]))


def classified(calls: DataFrame, params: Params) -> DataFrame:
    """calls with classification, filter_status and filter_reasons (each reason once, in order)."""
    own = F.array("signal_classification") if params.analysis == "ndigenome" else F.array().cast("array<string>")
    other = F.when(F.col("signal_classification") != "SSB", own).otherwise(F.array().cast("array<string>")) if params.analysis == "ndigenome" else own
    out = calls.withColumn("_artifact", artifact_reasons(params))
    out = out.withColumn("_all", F.array_distinct(F.concat("caller_reasons", "_artifact", other)))
    return out.withColumns(
        {
            "classification": F.when(F.size("_artifact") > 0, "ARTIFACT_RISK").otherwise(F.col("signal_classification")),
            "filter_status": F.when(F.size("_all") == 0, "PASS").otherwise("FILTERED"),
            "filter_reasons": F.array_join("_all", ";"),
        }
    ).drop("_artifact", "_all")


def call_table(calls: DataFrame, params: Params) -> DataFrame:
    """The public columns in their order."""
    one_based = {f"{p}position_1based": F.col(f"{p}position_0based") + 1 for p in ("", "forward_", "reverse_", "opposite_", "indel_")}
    named = calls.withColumnsRenamed({"pos": "position_0based", "indel_position": "indel_position_0based"})
    return named.withColumns({"sample": F.lit(params.sample), "analysis": F.lit(params.analysis)} | one_based).select(*CALL_COLUMNS)


def tier() -> Column:
    return F.when(F.col("filter_status") == "PASS", "high_confidence").when(F.col("classification") == "ARTIFACT_RISK", "artifact").otherwise("manual_review")
