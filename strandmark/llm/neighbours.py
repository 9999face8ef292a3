"""Operator 7: approximate nearest neighbours from randomly rotated one-bit codes.

A vector is taken relative to the nearest of some coarse centroids, normalised, rotated by a seeded random orthogonal matrix
and kept as its signs, one bit a dimension, with two correction scalars: its distance from the centroid and the inner
product f of the rotated unit vector with its own signs. A query is rotated once and quantised to ``QUERY_BITS`` bits a
dimension; its inner product with a code is then a sum of bit counts of ANDed words. Divided by f it estimates the inner
product of the vectors without bias, off by about sqrt((1 - f^2) / f^2 / (D - 1)); ``EPSILON`` times that, and times what
quantising has changed, bounds the squared distance from both sides.

Rows lie in blocks of one centroid. A block is left out for the queries whose k-th distance so far is less than any
distance to it can be. Of a block's codes those are measured in double precision on the original vectors whose lower
bound isn't above the query's k-th distance so far or the k-th upper bound of the block, whichever is less.

Every row is indexed. Centroids come from a bounded sample (some ``SAMPLE_ROWS`` rows). Cells of about ``GROUP_ROWS`` rows by
``GROUP_QUERIES`` queries are the tasks, and k rows a query leave a cell.

Edge cases: vectors that are null, zero, hold null or non-finite components take no part, as query or candidate, nor in the
sample, however many they are; vectors of several lengths are searched by length, each among its like (there's no distance to
others); a null id takes no part; candidates with the
query's id are its own row; equal vectors tie and the smaller id comes first; repeated rows are candidates each; rows
that repeat a query's id are searched each, and the k nearest of all are returned; fewer candidates than k are all returned;
an empty table gives an empty table; further columns don't matter.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import base

BLOCK_ROWS, QUERY_ROWS = 4096, 256
GROUP_ROWS, GROUP_QUERIES = 1 << 17, 1 << 16
SAMPLE_ROWS, CENTROIDS = 4096, 64
QUERY_BITS = 4
EPSILON = 2.6
SEED = 7


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, count: int = CENTROIDS, rounds: int = 8) -> np.ndarray:
    """Some k-means steps from evenly spaced rows of the sample."""
    centres = sample[np.unique(np.linspace(0, len(sample) - 1, max(1, min(count, len(sample) // 16))).astype(int))].copy()
    for _ in range(rounds):
        near = nearest_centroid(sample, centres)
        for k in range(len(centres)):
            if (own := near == k).any():
                centres[k] = sample[own].mean(axis=0)
    return centres


def nearest_centroid(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1) - 2 * x @ centres.T).argmin(axis=1)


def pack(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    packed = np.packbits(bits, axis=1, bitorder="little")
    wide = np.zeros((len(packed), 8 * -(-packed.shape[1] // 8)), np.uint8)
    wide[:, : packed.shape[1]] = packed
    return wide.view("<u8")


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, distance from the centre, f) of each row of x."""
    r = x - centre
    size = np.sqrt((r * r).sum(1))
    o = (r / np.maximum(size, 1e-300)[:, None]) @ turn
    return pack(o > 0), size.astype(np.float32), (np.abs(o).sum(1) / np.sqrt(x.shape[1])).astype(np.float32)


def bounds(queries: np.ndarray, words: np.ndarray, size: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of the squared distances of rotated queries, relative to the codes' centroid, to the codes."""
    dim = queries.shape[1]
    low = queries.min(axis=1)
    step = np.maximum(queries.max(axis=1) - low, 1e-30) / ((1 << QUERY_BITS) - 1)
    level = np.rint((queries - low[:, None]) / step[:, None]).astype(np.uint8)
    near = low[:, None] + step[:, None] * level
    planes = [pack(level >> j & 1) for j in range(QUERY_BITS)]
    ones = np.bitwise_count(words).sum(axis=1, dtype=np.int32)
    total = np.zeros((len(queries), len(words)), np.float32)
    for j, plane in enumerate(planes):
        for w in range(words.shape[1]):
            total += np.float32(1 << j) * np.bitwise_count(plane[:, w, None] & words[None, :, w])
    # signs are 2 b - 1 over the root of the dimension
    inner = (2 * (low[:, None] * ones + step[:, None] * total) - near.sum(axis=1)[:, None]) / np.sqrt(dim)
    q2 = (queries * queries).sum(axis=1)
    f = np.maximum(f, 1e-6).astype(float)
    wide = size.astype(float)
    middle = q2[:, None] + (wide**2)[None] - 2 * inner * (wide / f)[None]
    # the code's own error, and that of the quantised query against signs that are as good as random
    off = 2 * EPSILON * (np.sqrt(q2)[:, None] * (wide * np.sqrt(np.maximum(1 - f * f, 0)) / f)[None] / np.sqrt(max(1, dim - 1)) + np.sqrt(((queries - near) ** 2).sum(axis=1) / dim)[:, None] * (wide / f)[None])
    return middle - off, middle + off


def _rows(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors) of a batch (id, vector) that take part."""
    ids, vectors = batch.column(0), batch.column(1)
    good = pc.and_(pc.is_valid(vectors), pc.equal(pc.fill_null(pc.list_value_length(vectors), 0), dim))
    ids, vectors = ids.filter(good), vectors.filter(good)
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)  # null components become NaN
    fine = np.isfinite(x).all(1) & (x != 0).any(1)
    return ids.to_numpy(zero_copy_only=False).astype(np.int64)[fine], x[fine]


class Best:
    """The k nearest so far of each query: squared distances, rising, and ids."""

    def __init__(self, ids: np.ndarray, k: int) -> None:
        self.ids, self.k = ids, k
        self.square = np.full((len(ids), k), np.inf)
        self.found = np.zeros((len(ids), k), np.int64)

    def limit(self, some: np.ndarray) -> np.ndarray:
        """Squared distances from which nothing counts; a little more than the k-th, for what rounding does to bounds."""
        worst = self.square[some, -1]
        return worst + 1e-5 * (1 + np.abs(worst))

    def add(self, query: np.ndarray, vectors: np.ndarray, square: np.ndarray) -> None:
        """Pairs of query (by place) and vector."""
        some = np.unique(query)
        q = np.concatenate((np.repeat(some, self.k), query))
        d = np.concatenate((self.square[some].ravel(), square))
        v = np.concatenate((self.found[some].ravel(), vectors))
        order = np.lexsort((v, d, q))
        first = np.searchsorted(q[order], some)
        take = order[first[:, None] + np.arange(self.k)]
        self.square[some], self.found[some] = d[take], v[take]


def search_cell(q_ids: np.ndarray, q: np.ndarray, rotated: np.ndarray, blocks: list[tuple], centres: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vector id, distance): the k nearest of each query that the bounds let through, among blocks (centroid, ids,
    vectors, words, size, f); centres: the rotated centroids."""
    best = Best(q_ids, k)
    away = np.stack([np.sqrt(((rotated - c) ** 2).sum(axis=1)) for c in centres], axis=1)
    # blocks that are nearest to the queries as a whole come first, so that distances are soon short
    for c, ids, x, words, size, f in sorted(blocks, key=lambda b: float(away[:, b[0]].mean())):
        reach = np.maximum(away[:, c] - float(size.max(initial=0)) * (1 + 1e-6), 0) ** 2
        some = np.flatnonzero(reach <= best.limit(np.arange(len(q))))
        for a in range(0, len(some), QUERY_ROWS):
            part = some[a : a + QUERY_ROWS]
            lower, upper = bounds(rotated[part] - centres[c], words, size, f)
            own = q_ids[part, None] == ids[None]
            limit = best.limit(part)
            if len(ids) > k:
                worst = np.partition(np.where(own, np.inf, upper), k - 1, axis=1)[:, k - 1]
                limit = np.minimum(limit, np.where(np.isfinite(worst), worst + 1e-5 * (1 + np.abs(worst)), np.inf))
            i, j = np.nonzero((lower <= limit[:, None]) & ~own)
            for s in range(0, len(i), 1 << 16):
                at, v = part[i[s : s + (1 << 16)]], j[s : s + (1 << 16)]
                best.add(at, ids[v], ((x[v] - q[at]) ** 2).cumsum(axis=1)[:, -1])  # added up in order, as by definition
    query, place = np.nonzero(np.isfinite(best.square))
    return q_ids[query], best.found[query, place], np.sqrt(best.square[query, place])


def nearest(vectors: DataFrame, queries, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for the rows where ``queries`` holds, their k nearest among all other rows."""
    spark = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.where(F.col(id_col).isNotNull() & _usable(v)).select(F.col(id_col).cast("long").alias("id"), v.alias("v"), queries.alias("asks"))
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).orderBy("dim").collect()  # a row a length
    parts = [_nearest(rows.where(F.size("v") == s.dim), s.dim, s.n, s.q, k) for s in sizes if s.q]
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = reduce(DataFrame.union, parts).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _usable(v: Column) -> Column:
    return F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)  # NaN is above all


def _nearest(rows: DataFrame, dim: int, n: int, q: int, k: int) -> DataFrame:
    """(query_id, vec_id, score) of n rows (id, v, asks), q of them queries, of vectors of one length: the k nearest in each cell."""
    spark = rows.sparkSession
    sample = [r.v for r in rows.select("v").sample(min(1.0, SAMPLE_ROWS / n), SEED).collect()] or [r.v for r in rows.select("v").limit(SAMPLE_ROWS).collect()]
    turn = rotation(dim)
    centres = centroids(np.array(sorted(sample)))
    turned = centres @ turn
    groups = max(base.partitions_for(spark), -(-n // GROUP_ROWS))
    query_groups = max(1, -(-q // GROUP_QUERIES))

    def code_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of one centroid, as full as the partition's rows make them."""
        kept: dict[int, list[tuple]] = defaultdict(list)
        held: Counter = Counter()
        number, part = 0, TaskContext.get().partitionId()

        def block(c: int) -> pa.RecordBatch:
            nonlocal number
            columns = [np.concatenate(x) for x in zip(*kept.pop(c))]
            held[c] = 0
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([(part + 7919 * number) % groups], pa.int32()), pa.array([c], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in columns)], names)

        for batch in batches:
            ids, x = _rows(batch, dim)
            near = nearest_centroid(x, centres)
            for c in np.unique(near).tolist():
                own = np.flatnonzero(near == c)
                for a in range(0, len(own), BLOCK_ROWS):
                    some = own[a : a + BLOCK_ROWS]
                    kept[c].append((ids[some], x[some], *encode(x[some], centres[c], turn)))
                    held[c] += len(some)
                    if held[c] >= BLOCK_ROWS:
                        yield block(c)
        for c in list(kept):
            yield block(c)

    def query_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            ids, x = _rows(batch, dim)
            for a in range(0, len(ids), BLOCK_ROWS):
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array([(part + 7919 * number) % query_groups], pa.int32()), pa.array([ids[a : a + BLOCK_ROWS].tobytes()], pa.binary()), pa.array([x[a : a + BLOCK_ROWS].tobytes()], pa.binary())], ["qg", "ids", "q"])

    names = ["g", "c", "ids", "x", "words", "size", "f"]
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    blocks = rows.select("id", "v").mapInArrow(code_blocks, "g int, c int, ids binary, x binary, words binary, size binary, f binary").withColumn("qg", every(query_groups))
    asked = rows.where("asks").select("id", "v").mapInArrow(query_blocks, "qg int, ids binary, q binary").withColumn("g", every(groups))

    def cell(codes: pa.Table, asks: pa.Table) -> pa.Table:
        base.give_back()
        get = lambda value, kind: np.frombuffer(value, kind)
        empty = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        if not codes.num_rows or not asks.num_rows:
            return pa.table({c: pa.array([], t) for c, t in empty.items()})
        held = [(r["c"], get(r["ids"], np.int64), get(r["x"], float).reshape(-1, dim), get(r["words"], "<u8").reshape(len(r["ids"]) // 8, -1), get(r["size"], np.float32), get(r["f"], np.float32)) for r in codes.to_pylist()]
        q_ids = np.concatenate([get(x, np.int64) for x in asks["ids"].to_pylist()])
        q = np.concatenate([get(x, float) for x in asks["q"].to_pylist()]).reshape(-1, dim)
        return pa.table(dict(zip(empty, map(pa.array, search_cell(q_ids, q, q @ turn, held, turned, k)))))

    return blocks.groupBy("g", "qg").cogroup(asked.groupBy("g", "qg")).applyInArrow(cell, "query_id long, vec_id long, score double")


def op7_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, F.col("vec_id") % 100 == 0)


#: Every query against every row.
SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
usable AS (SELECT * FROM v WHERE len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(x, lambda e: e <> 0)) > 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(range(1, len(c.x) + 1), lambda i: (c.x[i] - q.x[i]) * (c.x[i] - q.x[i])), lambda a, b: a + b)) AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.x) = len(q.x)),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INT) AS rank, vec_id, score FROM pairs)
SELECT * FROM ranked WHERE rank <= 10
"""
