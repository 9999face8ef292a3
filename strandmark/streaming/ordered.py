"""Pile-ups of a stream of reads in coordinate order, with a bounded state.

Reads of a contig come by rising start, in files taken one after the other. Once a start has passed a place, no later read can end or
begin there: its counts are final, are given out once (append), and leave the state, which holds nothing but the places at or beyond the last start, so no more
than the reads that are still open there have ends. A read that goes back, within a file or against what has been taken before, is a fault
("not sorted"), as its place's counts may have been given out.

Each task first counts its own piece of a file (places, counts, first and last start), so a contig that most reads lie on sends
counts to its state and not reads. A batch may take several files at once where ``read_ord`` rises over all of them: pieces never span two parts of files, and
are put in order by it. ``in_turn`` gives the files of one parallel write the times by which a stream takes them in order. ``ended`` makes the rows that close contigs: a contig that is closed gives out all that is left and
takes no more reads.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strandmark.functions import reads as R
from strandmark.schema import READ_SCHEMA

#: A task's counts of a piece: order and starts of its ends, places (twice the position, plus one on the reverse strand), counts.
PIECE = "contig string, first_ord long, last_ord long, first_start long, last_start long, ended boolean, place binary, n binary"
COUNTS = "contig string, pos long, strand string, count long"
_PIECE = pa.schema([("contig", pa.string()), *[(c, pa.int64()) for c in ("first_ord", "last_ord", "first_start", "last_start")], ("ended", pa.bool_()), ("place", pa.binary()), ("n", pa.binary())])
STATE = "start long, ended boolean, place array<bigint>, n array<bigint>"
CLOSED = np.iinfo(np.int64).max


class NotSorted(ValueError):
    pass


def ended(spark: SparkSession, contigs: list[str]) -> DataFrame:
    """Rows, in the form of reads, that tell the end of contigs."""
    return spark.createDataFrame([(None, None, None, c, None, None, None, None, None) for c in contigs], READ_SCHEMA)


def _summed(place: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(place, return_inverse=True)
    return found, np.bincount(at, n, len(found)).astype(np.int64)


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (contig, split, ord, start, place, counts), in the order of a file; a task may have several splits, which needn't be neighbours."""
    for batch in batches:
        df = batch.to_pandas()
        for (contig, _), own in df.groupby(["contig", "split"], sort=False):
            over = own["start"].isna()
            reads = own[~over].sort_values("ord", kind="stable")
            start = reads["start"].to_numpy(np.int64)
            if (np.diff(start) < 0).any():
                raise NotSorted(f"reads of {contig} are not sorted by coordinate")
            some = reads[reads["counts"].astype(bool)]["place"].to_numpy(np.int64)
            place, n = _summed(some, np.ones(len(some)))
            order = reads["ord"].to_numpy(np.int64)
            bounds = [int(x[k]) for x in (order, start) for k in (0, -1)] if len(start) else [None] * 4
            row = [contig, *bounds, bool(over.any()), place.tobytes(), n.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _PIECE)], schema=_PIECE)


def passed(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Merges a batch's pieces of a contig into its state; gives out what the last start has passed."""
    start, over, place, n = state.get if state.exists else (-1, False, [], [])
    parts = pd.concat(list(frames))
    over = bool(over)
    with_reads = parts[parts["first_ord"].notna()].sort_values("first_ord")
    if over and len(with_reads):
        raise NotSorted(f"reads of {key[0]} after its end")
    for first, last in zip(with_reads["first_start"].astype(np.int64), with_reads["last_start"].astype(np.int64)):
        if first < start:
            raise NotSorted(f"reads of {key[0]} are not sorted by coordinate: {first} comes after {start}")
        start = max(start, last)
    places = [np.array(place, np.int64), *[np.frombuffer(b, np.int64) for b in parts["place"]]]
    counts = [np.array(n, np.int64), *[np.frombuffer(b, np.int64) for b in parts["n"]]]
    place, n = _summed(np.concatenate(places), np.concatenate(counts))
    over = over or bool(parts["ended"].any())
    out = place < 2 * (CLOSED // 2 if over else start)
    state.update((int(start), over, place[~out].tolist(), n[~out].tolist()))
    gone = place[out]
    yield pd.DataFrame({"contig": key[0], "pos": gone >> 1, "strand": np.where(gone & 1, "-", "+"), "count": n[out]})


def ordered_counts(reads: DataFrame, min_mapq: int) -> DataFrame:
    """(contig, pos, strand, count) of eligible reads' 5' ends, each place once, of a stream of reads in order (append)."""
    place = 2 * R.endpoint() + F.when(R.has(R.REVERSE), 1).otherwise(0)
    # a read that doesn't count still tells how far the stream has come
    split = F.xxhash64(F.input_file_name(), F.input_file_block_start())
    slim = reads.where("reference_start IS NULL OR flag & 4 = 0").select("contig", split.alias("split"), F.col("read_ord").alias("ord"), F.col("reference_start").alias("start"), place.cast("long").alias("place"), F.coalesce(R.eligible(min_mapq), F.lit(False)).alias("counts"))
    parts = slim.mapInArrow(pieces, PIECE)
    return parts.groupBy("contig").applyInPandasWithState(passed, COUNTS, STATE, "append", GroupStateTimeout.NoTimeout)


def in_turn(spark: SparkSession, folder: str) -> None:
    """Sets the times of a folder's files in the order of their names, a second apart, none later than the last one's."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted((f for f in fs.listStatus(Path(folder)) if f.getPath().getName()[0] not in "_."), key=lambda f: f.getPath().getName())
    last = max((f.getModificationTime() for f in files), default=0)
    for k, f in enumerate(files, 1):
        fs.setTimes(f.getPath(), last - 1000 * (len(files) - k), -1)


def run(spark: SparkSession, source: str, target: str, checkpoint: str, min_mapq: int = 1, files: int = 1, partitions: int | None = None) -> StreamingQuery:
    """Takes the files that have come to the folder, in the order of their times, so many a batch. Several need a ``read_ord`` that rises over them all.
    The state is dealt out by contig over ``partitions`` (of a new checkpoint; by default as many as the session's shuffles have)."""
    reads = spark.readStream.schema(READ_SCHEMA).option("maxFilesPerTrigger", files).parquet(source)
    writer = ordered_counts(reads, min_mapq).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions or usual))
        return writer.start()  # which takes the settings over
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)


def final(spark: SparkSession, target: str, min_count: int) -> DataFrame:
    """The places given out so far with at least min_count reads."""
    return spark.read.schema(COUNTS).parquet(target).where(F.col("count") >= min_count)
