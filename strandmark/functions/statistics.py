"""Scores and tests: pair score, single-precision contribution, Fisher's exact test, Benjamini-Hochberg."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from strandmark.operators import scans


def ratio(a: Column, b: Column) -> Column:
    """a / b, zero where b is zero."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def mean_or_zero(value: Column) -> Column:
    return F.coalesce(F.avg(value), F.lit(0.0))


def weighted_mean(a: Column, n: Column, b: Column, m: Column) -> Column:
    return ratio(a * n + b * m, n + m)


def pair_score(fc: Column, ff: Column, rc: Column, rf: Column) -> Column:
    return ff * rf * (fc + rc) / F.lit(4.0)


def contribution(c1: str, d1: str, c2: str, d2: str) -> str:
    """SQL of one single-precision score contribution; every step is rounded to FLOAT, as Spark divides in DOUBLE."""
    f = lambda x: f"CAST({x} AS FLOAT)"
    v = f(f"({f(c1)} - {f('1')})")
    v = f(f"{v} / {f(d1)}")
    v = f(f"{v} * {f(f'{f(c2)} - {f(1)}')}")
    v = f(f"{v} / {f(d2)}")
    v = f(f"{v} * {f(f'{f(f'{c1} + {c2}')} - {f(2)}')}")
    return f"CASE WHEN {d1} > 0 AND {d2} > 0 THEN {v} ELSE {f(0)} END"


def fold_enrichment(te: Column, td: Column, ce: Column, cd: Column) -> Column:
    return ((te + 0.5) / (td + 1.0)) / ((ce + 0.5) / (cd + 1.0))


@lru_cache(1 << 16)
def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """Sum of the tables' probabilities that don't exceed the observed one's by more than 1e-12 of it."""
    n1, n2, k = a + b, c + d, a + c
    if n1 + n2 == 0:
        return 1.0
    x = np.arange(max(0, k - n2), min(n1, k) + 1)
    g = math.lgamma
    row = g(n1 + 1) + g(n2 + 1) - (g(n1 + n2 + 1) - g(k + 1) - g(n1 + n2 - k + 1))
    logs = np.array([row - g(i + 1) - g(n1 - i + 1) - g(k - i + 1) - g(n2 - k + i + 1) for i in x.tolist()])
    p = np.exp(logs)
    return float(min(1.0, p[p <= p[a - x[0]] * (1 + 1e-12)].sum()))


@pandas_udf(DoubleType())
def fisher(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    """Distinct tables are computed once a batch, those that a worker has met before not at all."""
    tables = pd.DataFrame({"a": a, "b": b, "c": c, "d": d})
    distinct = tables.drop_duplicates()
    distinct = distinct.assign(p=[fisher_two_sided(*map(int, t)) for t in distinct.itertuples(index=False)])
    return tables.merge(distinct, on=["a", "b", "c", "d"], how="left")["p"].set_axis(a.index)


def benjamini_hochberg(df: DataFrame, p: str, q: str, by: list[str], tie: list[str]) -> DataFrame:
    """q values of the rows with a p value, over all rows of the same ``by``; null elsewhere.

    Equal p values share the largest rank, so rows pass as distinct p values with their counts, and those by ranges
    (operators.scans): ranks are running counts, and q is the running minimum from the largest p down.
    """
    one = df.withColumn("_q_rows", F.lit(0))
    by = [*by, "_q_rows"]
    counts = scans.ranged(one.where(F.col(p).isNotNull()).groupBy(*by, p).agg(F.count("*").alias("_n")), by, [p], "p-values")
    ranked = scans.before(counts, by, [p], {"_less": ("sum", "_n")}).join(F.broadcast(counts.groupBy(*by).agg(F.sum("_n").alias("_all"))), by)
    ranked = ranked.withColumn("_value", F.col(p) * F.col("_all") / (F.col("_less") + F.col("_n")))
    least = scans.before(ranked, by, [p], {"_above": ("min", "_value")}, backward=True)
    adjusted = least.select(*by, p, F.least(F.lit(1.0), "_value", "_above").alias(q))
    return one.join(adjusted, [*by, p], "left").drop("_q_rows")
