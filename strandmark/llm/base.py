"""Shared pieces: the shared folder, written intermediate tables, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmark.session import discard as discard
from strandmark.session import new_folder as new_folder
from strandmark.session import written as written

try:
    _LIBC = ctypes.CDLL("libc.so.6")
except OSError:
    _LIBC = None


#: What a worker keeps between batches and tasks, as tokenizers and what they have learned: one thing at a time.
_TOOLS: dict[tuple, Any] = {}


def tool(key: tuple, make: Callable[[], Any]) -> Any:
    """The worker's tool of this key, made if it's another one that is kept."""
    if key not in _TOOLS:
        forget()
        _TOOLS[key] = make()
    return _TOOLS[key]


def forget() -> None:
    """Lets the kept tool go: workers live on when a stage that needs no tool follows one that did."""
    _TOOLS.clear()
    give_back()


def give_back() -> None:
    """Returns freed memory to the system, where the C library can: an executor's workers share one limit."""
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest node reachable from each node of ``edges(a, b)``; returns (node, root).

    Alternates two steps until nothing changes, each a min-aggregation and a join: every node's larger
    neighbours move to the smallest node near it (large star), then its smaller neighbours do (small star).
    The edges only shrink in diameter, never in reach. Each round is written to the shared folder.
    Null ends and self loops are ignored; no edges give no rows.
    """
    spark = edges.sparkSession

    def digest(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    pairs = written(pairs, "components")
    before = digest(pairs)
    for _ in range(max_rounds):
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        old, pairs = pairs, written(small.select("e.*").where("a > b").distinct(), "components")
        discard(old)
        now = digest(pairs)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
