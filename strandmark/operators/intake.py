"""Intake of texts (lane files, notes of runs): what each holds, whether it has been there before, whether it's fit for use.

A text that is used twice counts its reads twice, so contents are told apart by SHA-256, as inputs are in a run's document. Complexity is
the measure of the read filter: of a hundred characters, how many are unlike the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATES = ("accepted", "blank", "low_complexity", "reused")


def complexity(text: Column) -> Column:
    """0 to 100; runs of one character are one, so changes are what is left but for the first. 100 for a single character."""
    n = F.char_length(text)
    changes = F.char_length(F.regexp_replace(text, r"(?s)(.)\1+", "$1")) - 1
    return F.when(n > 1, 100.0 * changes / (n - 1)).otherwise(100.0)


def described(texts: DataFrame, id_col: str, text_col: str, lane_col: str) -> DataFrame:
    """(id, lane, sha256, n_bytes, n_lines, blank, complexity) of each row; null texts are empty, null lanes are 'none'."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.when(text == "", 0).otherwise(F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"))) + (~F.endswith(text, F.lit("\n"))).cast("int"))
    return texts.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.nullif(F.col(lane_col).cast("string"), F.lit("")), F.lit("none")).alias("lane"),
        F.sha2(F.encode(text, "UTF-8"), 256).alias("sha256"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        lines.cast("long").alias("n_lines"),
        (~text.rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        complexity(text).alias("complexity"),
    )


def firsts(rows: DataFrame) -> DataFrame:
    """(sha256, first): the smallest id that has a content, of rows that aren't blank; rows without an id come last."""
    return rows.where("n_bytes > 0 AND NOT blank").groupBy("sha256").agg(F.min("id").alias("first"))


def judged(new: DataFrame, earlier: DataFrame | None, least_complexity: float) -> DataFrame:
    """new rows (of ``described``) with reuse_of and status. ``earlier``: (sha256, first) of contents that have been registered before.

    A content belongs to whoever had it first: an earlier row, else the smallest id among the new ones; others reuse it. A row
    of an id that has been taken in already with this content reuses it too. Blank texts reuse nothing. A digest is one row of the joined side, however many copies there are, and
    copies are counted down to it before any exchange.
    """
    own = firsts(new).withColumnRenamed("first", "_own")
    if earlier is not None:
        own = own.join(earlier.select("sha256", F.col("first").alias("_earlier"), F.lit(True).alias("_known")), "sha256", "left")
    else:
        own = own.withColumns({"_earlier": F.lit(None).cast(new.schema["id"].dataType), "_known": F.lit(None).cast("boolean")})
    known = F.coalesce("_known", F.lit(False))
    found = new.join(own, "sha256", "left").withColumn("_reused", ~F.col("blank") & (known | ~F.col("id").eqNullSafe(F.col("_own"))))
    status = F.when(F.col("blank"), "blank").when(F.col("_reused"), "reused").when(F.col("complexity") < least_complexity, "low_complexity").otherwise("accepted")
    return found.select(*new.columns, F.when(F.col("_reused"), F.when(known, F.col("_earlier")).otherwise(F.col("_own"))).alias("reuse_of"), status.alias("status"))


def by_lane(registry: DataFrame) -> DataFrame:
    """Texts and bytes of each lane by state."""
    counts = {f"n_{s}": F.count_if(F.col("status") == s) for s in STATES}
    return registry.groupBy("lane").agg(F.count("*").alias("n_texts"), F.sum("n_bytes").alias("n_bytes"), *[c.alias(n) for n, c in counts.items()])
