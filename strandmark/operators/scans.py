"""Running values along an order, without a task that holds a whole group.

Rows are range-partitioned by group and order and written, so that each row's range is fixed. A range is summed up in a row (its largest value,
its sum, its last value); these few rows are scanned, and each range starts from what the ranges before it have left. The windows over rows are
within a range; only the one over summaries, a row a range and group, sees a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandmark.session import by_rows, written

PART = "_part"


def ranged(df: DataFrame, by: list[str], order: list[str], name: str = "ranged") -> DataFrame:
    """df with ``_part``, the number of a row's range; numbers rise with (by, order)."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return by_rows(written(df.repartitionByRange(n, *by, *order).withColumn(PART, F.spark_partition_id()), name))


def _both(kind: str, here: Column, carried: Column) -> Column:
    if kind == "sum":
        return F.coalesce(here, F.lit(0)) + F.coalesce(carried, F.lit(0))
    return {"max": F.greatest(here, carried), "min": F.least(here, carried), "last": F.coalesce(here, carried)}[kind]


def before(rows: DataFrame, by: list[str], order: list[str], values: dict[str, tuple[str, str]], backward: bool = False) -> DataFrame:
    """rows (of ``ranged``, by the same columns) with, by new name, (kind, column): the ``max``, ``min``, ``sum`` or ``last`` value of that column over the
    rows of the group that come before in the order, or behind with ``backward``; null (a sum: 0) where there are none.

    Rows that are equal in all of ``order`` have no order among themselves.
    """
    turn = (lambda c: F.col(c).desc()) if backward else F.col
    summed = {"max": F.max, "min": F.min, "sum": F.sum}
    furthest = F.min_by if backward else F.max_by
    one = {n: furthest(c, F.struct(*order)) if kind == "last" else summed[kind](c) for n, (kind, c) in values.items()}
    past = Window.partitionBy(*by).orderBy(turn(PART)).rowsBetween(Window.unboundedPreceding, -1)
    carry = {n: F.last(n, ignorenulls=True).over(past) if kind == "last" else summed[kind](n).over(past) for n, (kind, _) in values.items()}
    summaries = rows.groupBy(*by, PART).agg(*[c.alias(n) for n, c in one.items()])
    carried = summaries.select(*by, PART, *[c.alias(f"_carried_{n}") for n, c in carry.items()])
    within = Window.partitionBy(*by, PART).orderBy(*map(turn, order))
    upto = within.rowsBetween(Window.unboundedPreceding, -1)
    here = {n: F.lag(c).over(within) if kind == "last" else summed[kind](c).over(upto) for n, (kind, c) in values.items()}
    # the join has the windows' partitioning, so rows are exchanged once for both
    joined = rows.join(carried, [*by, PART])
    return joined.withColumns({n: _both(kind, here[n], F.col(f"_carried_{n}")) for n, (kind, _) in values.items()}).drop(*[f"_carried_{n}" for n in values])


def islands(rows: DataFrame, by: list[str], order: list[str], low: str, high: str, name: str, touching: bool) -> DataFrame:
    """rows with ``name``: spans (low, high) in the order of their lows that overlap, directly or over others, have one number in a group, counted from 1.
    With ``touching`` a span that begins where others end belongs to them."""
    seen = before(rows, by, order, {"_reached": ("max", high)})
    apart = F.col(low) > F.col("_reached") if touching else F.col(low) >= F.col("_reached")
    flagged = seen.withColumn("_new", (F.col("_reached").isNull() | apart).cast("int")).drop("_reached")
    counted = before(flagged, by, order, {name: ("sum", "_new")})
    return counted.withColumn(name, (F.col(name) + F.col("_new")).cast("long")).drop("_new")
