"""Interval sets and interval joins.

Intervals are rows (contig, start, end), half-open. Joins by overlap never compare a contig with itself: one side gets
one bin for each probed position, the other one for each bin that it covers, so each pair meets once, in an equi-join
on (contig, bin), which Spark may broadcast when a side's measured size allows it and splits when a bin is hot.

Bins have several widths (``WIDTHS`` times ``BIN``). An interval lies at the first level where it covers nine bins at most, or
at the widest, so one of 200 megabases is 13 rows; a point asks every level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandmark.operators import scans

BIN = 1024
#: Widths of the levels, in bins.
WIDTHS = (1, 128, 16_384)


def merge(intervals: DataFrame) -> DataFrame:
    """Overlapping and adjacent intervals become one."""
    rows = scans.ranged(intervals.select("contig", "start", "end").distinct(), ["contig"], ["start", "end"], "mask-ranges")
    found = scans.islands(rows, ["contig"], ["start", "end"], "start", "end", "_island", touching=True)
    return found.groupBy("contig", "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def totals(merged: DataFrame) -> DataFrame:
    """(interval_count, excluded_bases) of merged intervals."""
    return merged.agg(F.count("*").alias("interval_count"), F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0)).alias("excluded_bases"))


def covering_bins(start: Column, end: Column) -> Column:
    """Bins of a half-open interval that isn't empty."""
    return F.sequence(F.floor(start / BIN), F.floor((end - 1) / BIN))


def with_bins(df: DataFrame, start: Column, end: Column, name: str = "_bin") -> DataFrame:
    return df.where(end > start).withColumn(name, F.explode(covering_bins(start, end)))


def _level(start: Column, end: Column) -> Column:
    """Where an interval lies, by its length."""
    size = end - start
    return F.when(size <= 8 * BIN * WIDTHS[0], 0).when(size <= 8 * BIN * WIDTHS[1], 1).otherwise(2)


def _width() -> Column:
    """Of the bins of ``_level``."""
    return BIN * F.when(F.col("_level") == 0, WIDTHS[0]).when(F.col("_level") == 1, WIDTHS[1]).otherwise(WIDTHS[2])


def at_home(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """df with a row (``_level``, ``_bin``) for each bin that an interval covers at its own level; empty intervals go."""
    own = df.where(end > start).withColumn("_level", _level(start, end))
    return own.withColumn("_bin", F.explode(F.sequence(F.floor(start / _width()), F.floor((end - 1) / _width()))))


def at_positions(points: DataFrame, intervals: DataFrame, pos: str = "pos", how: str = "inner") -> DataFrame:
    """points(contig, pos, ...) with the intervals that contain them; ``how`` may be left_semi or left_anti.

    What is outside of all (left_anti) passes the levels one after the other: no point is repeated for it, and a level without intervals
    is left out at run time.
    """
    homes = at_home(intervals, F.col("start"), F.col("end"))
    within = (F.col("p.contig") == F.col("i.contig")) & (F.col("p._bin") == F.col("i._bin")) & (F.col(f"p.{pos}") >= F.col("i.start")) & (F.col(f"p.{pos}") < F.col("i.end"))
    if how == "left_anti":
        left = points
        for k, width in enumerate(WIDTHS):
            p = left.withColumn("_bin", F.floor(F.col(pos) / (BIN * width))).alias("p")
            left = p.join(homes.where(F.col("_level") == k).alias("i"), within, how).drop("_bin")
        return left
    if how == "left_semi":
        hits = at_positions(points.select("contig", F.col(pos).alias("_at")).distinct(), intervals.select("contig", "start", "end"), "_at")
        return points.join(hits.select("contig", F.col("_at").alias(pos)).distinct(), ["contig", pos], how).select(*points.columns)
    places = F.array(*[F.struct(F.lit(k).alias("_level"), F.floor(F.col(pos) / (BIN * w)).alias("_bin")) for k, w in enumerate(WIDTHS)])
    p = points.withColumn("_place", F.explode(places)).select("*", "_place._level", "_place._bin").drop("_place").alias("p")
    joined = p.join(homes.alias("i"), within & (F.col("p._level") == F.col("i._level")), how)
    return joined.select("p.*", *[F.col(f"i.{c}") for c in intervals.columns if c != "contig"]).drop("_bin", "_level")


def _in_levels(df: DataFrame, start: Column, end: Column, name: str) -> DataFrame:
    """df with a row for each bin at its own level and at all wider ones; ``name`` tells which rows are at their own."""
    own = df.where(end > start).withColumn("_own", _level(start, end)).withColumn("_level", F.explode(F.sequence(F.col("_own"), F.lit(len(WIDTHS) - 1))))
    bins = F.sequence(F.floor(start / _width()), F.floor((end - 1) / _width()))
    return own.withColumn("_bin", F.explode(bins)).withColumn(name, F.col("_own") == F.col("_level")).drop("_own")


def covered(points: DataFrame, intervals: DataFrame, offsets: list[int], name: str) -> DataFrame:
    """(contig, pos, name) of the points(contig, pos) with an interval nearby: bit k of ``name`` is set where pos + offsets[k] lies in one. A point
    is a row a level (two across a bin's end), not one for each offset."""
    low, high = F.col("pos") + min(offsets), F.col("pos") + max(offsets) + 1
    level = lambda k, w: F.transform(F.sequence(F.floor(low / (BIN * w)), F.floor((high - 1) / (BIN * w))), lambda b: F.struct(F.lit(k).alias("_level"), b.alias("_bin")))
    p = points.select("contig", "pos", F.explode(F.concat(*[level(k, w) for k, w in enumerate(WIDTHS)])).alias("_place")).select("contig", "pos", "_place.*")
    homes = at_home(intervals.select("contig", "start", "end"), F.col("start"), F.col("end"))
    hits = p.join(homes, ["_bin", "_level", "contig"]).where((F.col("start") < high) & (F.col("end") > low))
    within = lambda o: (F.col("start") <= F.col("pos") + o) & (F.col("pos") + o < F.col("end"))
    bits = sum((F.when(within(o), F.lit(1 << k)).otherwise(0) for k, o in enumerate(offsets)), F.lit(0).cast("long"))
    return hits.groupBy("contig", "pos").agg(F.bit_or(bits).alias(name))


def outside(points: DataFrame, mask: DataFrame | None, pos: str = "pos") -> DataFrame:
    return points if mask is None else at_positions(points, mask, pos, "left_anti")


def subtract(intervals: DataFrame, merged: DataFrame) -> DataFrame:
    """What is left of each interval (contig, start, end) without the merged mask; whole gaps, clipped."""
    own = intervals.select("contig", F.col("start").alias("own_start"), F.col("end").alias("own_end")).distinct()
    # two intervals meet at the wider one's level
    a = _in_levels(own, F.col("own_start"), F.col("own_end"), "_a")
    b = _in_levels(merged.select("contig", "start", "end"), F.col("start"), F.col("end"), "_b")
    hits = a.join(b, ["contig", "_level", "_bin"]).where("(_a OR _b) AND start < own_end AND end > own_start").select("contig", "own_start", "own_end", "start", "end").distinct()
    keys = ["contig", "own_start", "own_end"]
    w = Window.partitionBy(*keys).orderBy("start")
    gaps = hits.select(*keys, F.col("end").alias("from"), F.lead("start").over(w).alias("to"), F.lag("end").over(w).alias("_prev"), "start")
    after = gaps.select(*keys, "from", F.coalesce("to", "own_end").alias("to"))
    first = gaps.where("_prev IS NULL").select(*keys, F.col("own_start").alias("from"), F.col("start").alias("to"))
    whole = own.join(hits.select(*keys).distinct(), keys, "left_anti").select(*keys, F.col("own_start").alias("from"), F.col("own_end").alias("to"))
    left = after.union(first).union(whole)
    clipped = left.select(*keys, F.greatest("from", "own_start").alias("start"), F.least("to", "own_end").alias("end"))
    return clipped.where("start < end")


def overlap_bases(intervals: DataFrame, merged: DataFrame) -> DataFrame:
    """Masked bases of each interval."""
    left = subtract(intervals, merged).groupBy("contig", "own_start", "own_end").agg(F.sum(F.col("end") - F.col("start")).alias("_open"))
    own = intervals.select("contig", F.col("start").alias("own_start"), F.col("end").alias("own_end")).distinct()
    masked = F.col("own_end") - F.col("own_start") - F.coalesce("_open", F.lit(0))
    return own.join(left, ["contig", "own_start", "own_end"], "left").select("contig", F.col("own_start").alias("start"), F.col("own_end").alias("end"), masked.alias("masked_bases"))


def coverage_faults(intervals: DataFrame, contigs: DataFrame) -> DataFrame:
    """(contig, at, fault): gaps and overlaps of intervals that should tile the contigs(contig, length)."""
    # equal intervals are told apart by a number, of which only the first follows what lies before
    own = intervals.groupBy("contig", "start", "end").agg(F.count("*").alias("_n"))
    rows = scans.before(scans.ranged(own, ["contig"], ["start", "end"], "interval-ranges"), ["contig"], ["start", "end"], {"before": ("last", "end")})
    again = rows.where("_n > 1").select("contig", "start", "end", F.col("end").alias("before"), F.explode(F.expr("sequence(2, _n)"))).drop("col")
    walked = rows.select("contig", "start", "end", F.coalesce("before", F.lit(0)).alias("before")).union(again)
    inner = walked.where("start <> before").select("contig", F.col("before").alias("at"), F.when(F.col("start") > F.col("before"), "gap").otherwise("overlap").alias("fault"))
    ends = contigs.join(intervals.groupBy("contig").agg(F.max("end").alias("last")), "contig", "left").where("coalesce(last, 0) <> length")
    return inner.union(ends.select("contig", F.coalesce("last", F.lit(0)).alias("at"), F.lit("end").alias("fault")))
