"""Operator 10: token ids as length-delimited binary records with masked checksums, and a separate offset index.

File format. A data file is a row of frames, each

    length   8 bytes, little-endian: bytes of the payload
    check    4 bytes: masked CRC-32 of those 8 bytes
    payload  1 if there's a key, else 0 (1 byte), the key (8 bytes, signed), the ids, 2 bytes each (4 if the vocabulary
             needs them)
    check    4 bytes: masked CRC-32 of the payload
    0x0A     ends the frame

masked(c) = ((c >> 15 | c << 17) + 0xa282ead8) mod 2**32. Spark's text sink puts the bytes out unchanged and ends
each frame with the 0x0A, so files go to any Hadoop file system under Spark's commit protocol: a lost executor
leaves no half-written file behind. Files are rolled by bytes: there are so many that each has about ``FILE_BYTES`` of
text, since Spark reads a file as one value, of 2 GB at most. The index is a Parquet table (key, file, offset, length, n_ids,
ids_crc32, start). Reads by the index open the files that it names and no others, and look at the named ranges in them.

Edge cases: a null or empty text is a record with the end id alone; repeated keys are kept as records of their own;
records without a key come before all others; records of one key lie in the order of a hash of their texts, so that a key
that very many have is spread over files like any others; no documents give a folder without records and an empty index.
"""

from __future__ import annotations

import itertools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import base, tokens

MASK_DELTA = 0xA282EAD8
#: Bytes in a payload before the ids: whether there's a key, and the key.
LEAD_BYTES = 9
#: Bytes of text for which there is a file.
FILE_BYTES = 128 << 20


def masked(data: bytes) -> bytes:
    c = zlib.crc32(data)
    return struct.pack("<I", ((c >> 15 | c << 17) + MASK_DELTA) & 0xFFFFFFFF)


def frame(payload: bytes) -> bytes:
    """The payload between its length and checks, without the ending 0x0A."""
    head = struct.pack("<Q", len(payload))
    return b"".join((head, masked(head), payload, masked(payload)))


def frame_at(content: bytes, at: int) -> bytes:
    """The payload of the frame that begins there; ValueError where its length or a check is wrong."""
    head = content[at : at + 8]
    if len(head) < 8 or content[at + 8 : at + 12] != masked(head):
        raise ValueError(f"length of the frame at {at} is wrong")
    (n,) = struct.unpack("<Q", head)
    payload = content[at + 12 : at + 12 + n]
    if content[at + 12 + n : at + 17 + n] != masked(payload) + b"\n":
        raise ValueError(f"checksum of the frame at {at} is wrong")
    return payload


def lead(key: int | None) -> bytes:
    return struct.pack("<?q", key is not None, key or 0)


def key_of(payload: bytes) -> int | None:
    has, key = struct.unpack_from("<?q", payload)
    return key if has else None


def parse(content: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, payload) of each frame of a file."""
    at = 0
    while at < len(content):
        payload = frame_at(content, at)
        yield at, payload
        at += 17 + len(payload)


def write_records(docs: DataFrame, path: str, tokenizer: str, drops_space: bool, end_id: int, id_bytes: int = 2, key: str = "doc_id", text: str = "text", files: int | None = None) -> None:
    """Encodes every text and writes the frames in ascending order of key, those without one first: file after file, frame
    after frame."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("t"))
    n = files or max(base.partitions_for(spark), -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // FILE_BYTES))
    dtype = np.dtype(f"<u{id_bytes}")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = tokens.encoder(tokenizer, drops_space)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for i, j in tokens.slices(texts):
                flat, at = tool.encode(texts[i:j])
                if len(flat) and int(flat.max()) >> 8 * id_bytes:
                    raise ValueError(f"an id needs more than {id_bytes} bytes")
                flat, end = flat.astype(dtype), np.array([end_id], dtype).tobytes()
                payloads = [lead(k) + flat[a:b].tobytes() + end for k, a, b in zip(keys[i:j], at, at[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(list(map(frame, payloads)), pa.binary())], ["frame"])

    ordered = rows.repartitionByRange(n, "key", "t").sortWithinPartitions("key", "t")
    ordered.select("key", "text").mapInArrow(encode, "frame binary").select(F.col("frame").cast("string").alias("value")).write.text(path)


def read_records(spark, path: str, id_bytes: int = 2) -> DataFrame:
    """Every record of the folder: (key, file, offset, length, n_ids, ids_crc32, ids); checks are verified.

    ``file`` is the data file's number, in ascending order of keys; ids_crc32 is over 4-byte little-endian ids.
    """
    dtype = np.dtype(f"<u{id_bytes}")
    names = ["key", "file", "offset", "length", "n_ids", "ids_crc32", "ids"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = parse(content.as_py())
                while part := list(itertools.islice(found, 4096)):
                    ids = [np.frombuffer(p, dtype, offset=LEAD_BYTES).astype("<u4").tobytes() for _, p in part]
                    columns = [
                        [key_of(p) for _, p in part],
                        [number] * len(part),
                        [o for o, _ in part],
                        [len(p) + 17 for _, p in part],
                        [len(x) // 4 for x in ids],
                        [zlib.crc32(x) for x in ids],
                        ids,
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "ids" else pa.int64()) for c, n in zip(columns, names)], names)

    files = _files(spark, path).select(_number(), "content")
    return files.mapInArrow(read, "key long, file long, offset long, length long, n_ids long, ids_crc32 long, ids binary")


def _number() -> Column:
    """A data file's number, in ascending order of keys."""
    return F.regexp_extract("path", r"/part-(\d+)[^/]*$", 1).cast("long").alias("file")


def _files(spark, *paths: str) -> DataFrame:
    """The data files of these folders, or these files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(list(paths))


def with_starts(records: DataFrame) -> DataFrame:
    """``start``: ids of all records before this one. One row a file goes through one task, nothing else does."""
    totals = records.groupBy("file").agg(F.sum("n_ids").alias("n"))
    before = totals.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))
    inside = F.sum("n_ids").over(Window.partitionBy("file").orderBy("offset")) - F.col("n_ids")
    return records.withColumn("inside", inside).join(before, "file").withColumn("start", F.col("before") + F.col("inside")).drop("before", "inside")


def write_index(records: DataFrame, path: str) -> None:
    """The offset index for shuffled reads: where each record lies, beside the data. The files are read once."""
    with_starts(base.written(records.drop("ids"), "offsets")).select("key", "file", "offset", "length", "n_ids", "ids_crc32", "start").write.parquet(path)


def read_at(spark, path: str, index: DataFrame, id_bytes: int = 2) -> DataFrame:
    """The records that rows of the index name: (key, ids), however the index was filtered or shuffled; each once.

    Opens the files that have such records and no others (their names, a row a file, come to the driver).
    """
    dtype = np.dtype(f"<u{id_bytes}")
    wanted = index.groupBy("file").agg(F.sort_array(F.collect_set("offset")).alias("offsets"))
    named = {r["file"] for r in wanted.select("file").collect()}
    places = [r["path"] for r in _files(spark, path).select(_number(), "path").collect() if r["file"] in named]
    if not places:
        return spark.createDataFrame([], "key long, ids binary")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, offsets in zip(batch.column(0), batch.column(1)):
                content = content.as_py()
                for part in itertools.batched(offsets.as_py(), 4096):
                    payloads = [frame_at(content, o) for o in part]
                    columns = [pa.array([key_of(p) for p in payloads], pa.int64()), pa.array([np.frombuffer(p, dtype, offset=LEAD_BYTES).astype("<u4").tobytes() for p in payloads], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "ids"])

    return _files(spark, *places).select(_number(), "content").join(wanted, "file").select("content", "offsets").mapInArrow(read, "key long, ids binary")


def op10_token_records(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = base.new_folder(spark, "records")
    write_records(docs, f"{path}/data", "byte_bpe_50k.json", False, 0)
    write_index(read_records(spark, f"{path}/data"), f"{path}/index")
    index = spark.read.parquet(f"{path}/index")
    return index.select(F.col("key").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), "ids_crc32")
