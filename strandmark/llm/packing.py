"""Operator 1: best-two-fit packing of tokenized documents into sequences of at most ``capacity`` tokens.

Documents longer than the capacity are cut into pieces of exactly the capacity, the last one shorter. Pieces of one
length can stand for each other, so the packing is planned on the histogram of lengths (at most ``capacity`` rows,
however many documents there are): a bin is filled greedily, longest fitting piece first; then its smallest piece is
replaced by the two unpacked pieces that fill the expanded gap more tightly, again and again while that helps. A
finished bin's pattern is used as often as the counts allow, so one step packs many equal bins. The plan has few
thousand patterns whatever the input, and its size depends on the capacity alone.

Pieces then take their place by rank: the n-th piece of a length goes where the plan puts it. Ranks are counted in
two steps (inside each written partition, then over partitions), so no length's pieces ever meet in one task.

Edge cases: null or empty texts are the end id alone; repeated rows and ids are pieces of their own; equal lengths are
told apart by partition and order in it only; no documents give no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import base, tokens


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """(times, lengths) patterns that use up ``counts`` (pieces by length)."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens")
        left[length] += n
    out: list[tuple[int, list[int]]] = []
    present = np.flatnonzero(left)
    while len(present):
        bin_ = [int(present[-1])]
        used = {bin_[0]: 1}
        gap = capacity - bin_[0]

        def free(length: int) -> bool:
            return left[length] > used.get(length, 0)

        k = int(np.searchsorted(present, gap, side="right")) - 1
        while gap and k >= 0:
            length = int(present[k])
            if length <= gap and free(length):
                bin_.append(length)
                used[length] = used.get(length, 0) + 1
                gap -= length
                k = int(np.searchsorted(present, gap, side="right")) - 1
            else:
                k -= 1
        while gap and len(bin_) > 1:
            smallest = bin_[-1]
            room = gap + smallest
            pair = _two(present, room, smallest, free, lambda x: left[x] - used.get(x, 0) >= 2)
            if pair is None:
                break
            bin_.pop()
            used[smallest] -= 1
            for length in pair:
                bin_.append(length)
                used[length] = used.get(length, 0) + 1
            bin_.sort(reverse=True)
            gap = room - sum(pair)
        times = min(int(left[x]) // n for x, n in used.items() if n)
        for x, n in used.items():
            left[x] -= n * times
        out.append((times, bin_))
        present = present[left[present] > 0]
    return out


def _two(present: np.ndarray, room: int, smallest: int, free, twice) -> tuple[int, int] | None:
    """Two unpacked lengths of the largest sum over ``smallest`` and up to ``room``, or None."""
    best, found = smallest, None
    i, j = 0, int(np.searchsorted(present, room, side="right")) - 1
    while i <= j:
        a, b = int(present[i]), int(present[j])
        if a + b > room or not free(b):
            j -= 1
        elif not free(a) or (i == j and not twice(a)):
            i += 1
        else:
            if a + b > best:
                best, found = a + b, (b, a)
                if best == room:
                    break
            i += 1
    return found


def placements(patterns: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """The plan by length and rank: from rank ``first`` on, ``each`` pieces a bin go to bins ``sequence``, ... at ``offset`` + k * length."""
    rows, used, sequence = [], {}, 0
    for times, lengths in patterns:
        at = 0
        for length in sorted(set(lengths), reverse=True):
            each = lengths.count(length)
            rows.append((length, used.get(length, 0), each, sequence, at))
            used[length] = used.get(length, 0) + each * times
            at += length * each
        sequence += times
    rows.sort()
    names = ("length", "first", "each", "sequence", "offset")
    return dict(zip(names, np.array(rows, np.int64).reshape(-1, 5).T))


def pieces(docs: DataFrame, capacity: int, tokenizer: str, drops_space: bool, end_id: int, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, part, rank[, ids]); rank counts a length's pieces inside its partition."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["id", "piece", "start", "length", "ids_crc32", "part", "rank"] + ["ids"] * with_ids
    schema = f"id {id_type}, piece int, start long, length long, ids_crc32 long, part int, rank long" + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, seen = tokens.encoder(tokenizer, drops_space), np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            texts = batch.column(1)
            for i, j in tokens.slices(texts):
                flat, at = tool.encode(texts[i:j])
                owner, piece, start, length, crc, rank, raw = [], [], [], [], [], [], []
                for k, (a, b) in enumerate(zip(at, at[1:])):
                    ids = np.append(flat[a:b], end_id).astype("<u4")
                    for n, s in enumerate(range(0, len(ids), capacity)):
                        data = ids[s : s + capacity].tobytes()
                        size = len(data) // 4
                        owner.append(i + k)
                        piece.append(n)
                        start.append(s)
                        length.append(size)
                        crc.append(zlib.crc32(data))
                        rank.append(seen[size])
                        seen[size] += 1
                        if with_ids:
                            raw.append(data)
                columns = [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array([part] * len(owner), pa.int32()), pa.array(rank, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(raw, pa.binary())] * with_ids, names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def pack(docs: DataFrame, capacity: int, tokenizer: str, drops_space: bool, end_id: int, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) of every piece."""
    cut = base.written(pieces(docs, capacity, tokenizer, drops_space, end_id, id_col, text_col, with_ids), "pieces")
    by_part = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    by_part = by_part.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    where = placements(plan(counts, capacity))
    names = ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids
    schema = f"id {cut.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long" + ", ids binary" * with_ids

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = 1 << 50
        keys = where["length"] * top + where["first"]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("place").to_numpy()
            k = np.searchsorted(keys, length * top + rank, side="right") - 1
            n, m = np.divmod(rank - where["first"][k], where["each"][k])
            columns = [batch.column(c) for c in names[:5]] + [pa.array(where["sequence"][k] + n), pa.array(where["offset"][k] + m * length)]
            yield pa.RecordBatch.from_arrays(columns + ([batch.column("ids")] if with_ids else []), names)

    ranked = cut.join(by_part, ["length", "part"]).withColumn("place", F.col("before") + F.col("rank"))
    return ranked.mapInArrow(place, schema)


def op1_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs, 4096, "word_bpe_49k.json", True, 1).withColumnRenamed("id", "doc_id")
