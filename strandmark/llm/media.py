"""Operator 3: media columns of lossless WebP images.

``stored`` turns binary payloads into WebP bytes: grey images, an 8-bit sample a payload byte, 64 pixels a row and 128 rows at
most, in as many files one after another as that takes. ``read_back`` decodes a media column to its pixel arrays, and
computes digests and features from them; ``pixels`` writes the arrays themselves (width, height, R, G, B samples) for any
lossless WebP. All of it is one pass without a shuffle, batch by batch.

Edge cases: null or empty payloads become one row of blanks; broken media raise (ValueError names the cause); equal
payloads give equal bytes; repeated rows stay; columns of the input are carried along, those named like a result are
replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import base, tokens, webp

#: Payloads are filled up to a multiple of this.
UNIT = 192
#: Payload bytes of the largest single image.
IMAGE_BYTES = webp.ROW * webp.MAX_ROWS
#: Payload and media bytes of which images are made and read together.
TOGETHER = 6_000_000


def padded(payload: bytes | None) -> bytes:
    payload = payload or b""
    return payload + b" " * (-len(payload) % UNIT if payload else UNIT)


def to_media(payloads: list[bytes]) -> list[bytes]:
    cut = [[p[a : a + IMAGE_BYTES] for a in range(0, len(p), IMAGE_BYTES)] for p in payloads]
    made = iter(webp.encode_many([x for c in cut for x in c]))
    return [b"".join(next(made) for _ in c) for c in cut]


def images_of(media: list[bytes]) -> list[list[np.ndarray]]:
    """The R, G, B pixel arrays of each."""
    cut = [webp.files(m) for m in media]
    made = iter(webp.decode_many([x for c in cut for x in c]))
    return [[next(made) for _ in c] for c in cut]


def from_media(media: list[bytes]) -> list[list[np.ndarray]]:
    """The grey samples of each one's pixel arrays."""
    return [list(map(samples, images)) for images in images_of(media)]


def samples(image: np.ndarray) -> np.ndarray:
    """The grey samples of a pixel array; ValueError if it isn't grey."""
    if not ((image[..., 0] == image[..., 1]).all() and (image[..., 2] == image[..., 1]).all()):
        raise ValueError("a stored payload is a grey image")
    return np.ascontiguousarray(image[..., 1])


def feature(images: list[np.ndarray]) -> str:
    """Size, mean (of 1/256) and largest sample, and mean step (of 1/256) between neighbours in a row, all exact integers."""
    h, w = sum(len(x) for x in images), images[0].shape[1]
    total = sum(int(x.sum(dtype=np.int64)) for x in images)
    steps = sum(int(np.abs(np.diff(x.astype(np.int16), axis=1)).sum(dtype=np.int64)) for x in images)
    return f"{w}x{h};mean256={total * 256 // (h * w)};max={max(int(x.max()) for x in images)};step256={steps * 256 // (h * (w - 1))}"


def _schema(df: DataFrame, added: dict[str, str]) -> tuple[list[str], str]:
    rest = [c for c in df.columns if c not in added]
    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*rest).schema.fields]
    return rest, ", ".join(own + [f"{n} {t}" for n, t in added.items()])


def stored(df: DataFrame, payload: str, media: str = "media") -> DataFrame:
    """df with the media column of the payload column (binary); the payload leaves."""
    df = df.withColumnRenamed(payload, "_payload")
    rest, schema = _schema(df.drop("_payload"), {"n_bytes": "long", media: "binary"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(rest))
            for a, b in tokens.slices(column, TOGETHER):
                own = column[a:b].to_pylist()
                made = to_media([padded(p) for p in own])
                yield pa.RecordBatch.from_arrays([*(c[a:b] for c in batch.columns[: len(rest)]), pa.array([len(p or b"") for p in own], pa.int64()), pa.array(made, pa.binary())], [*rest, "n_bytes", media])

    return df.select(*rest, "_payload").mapInArrow(run, schema)


def read_back(df: DataFrame, media: str = "media") -> DataFrame:
    """df with digests of the stored form and of the samples read from it, and their feature; the media leave."""
    added = {"payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "media_bytes": "long", "media_sha256": "string", "feature": "string"}
    df = df.withColumnRenamed(media, "_media")
    rest, schema = _schema(df.drop("_media"), added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(rest))
            for a, b in tokens.slices(column):
                own = column[a:b].to_pylist()
                images = from_media(own)
                payloads = [b"".join(x.tobytes() for x in i) for i in images]
                columns = [
                    [len(s) for s in payloads],
                    [hashlib.sha256(s).hexdigest() for s in payloads],
                    [zlib.crc32(s[-16:]) for s in payloads],
                    [len(m) for m in own],
                    [hashlib.sha256(m).hexdigest() for m in own],
                    [feature(i) for i in images],
                ]
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([*(c[a:b] for c in batch.columns[: len(rest)]), *map(pa.array, columns, kinds)], [*rest, *added])

    return df.select(*rest, "_media").mapInArrow(run, schema)


def pixels(df: DataFrame, media: str = "media") -> DataFrame:
    """(every other column, image, width, height, samples): the R, G, B arrays of each file of the media column; null media give no rows."""
    df = df.where(F.col(media).isNotNull()).withColumnRenamed(media, "_media")
    rest, schema = _schema(df.drop("_media"), {"image": "int", "width": "int", "height": "int", "samples": "binary"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(rest))
            for a, b in tokens.slices(column):
                images = images_of(column[a:b].to_pylist())
                flat = [(a + k, n, x) for k, i in enumerate(images) for n, x in enumerate(i)]
                owner = pa.array([k for k, _, _ in flat], pa.int64())
                made = [pa.array([n for _, n, _ in flat], pa.int32()), pa.array([x.shape[1] for _, _, x in flat], pa.int32()), pa.array([x.shape[0] for _, _, x in flat], pa.int32()), pa.array([x.tobytes() for _, _, x in flat], pa.binary())]
                yield pa.RecordBatch.from_arrays([*(c.take(owner) for c in batch.columns[: len(rest)]), *made], [*rest, "image", "width", "height", "samples"])

    return df.select(*rest, "_media").mapInArrow(run, schema)


def op3_media_columns(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.encode("text", "UTF-8").alias("payload"))
    return read_back(base.written(stored(docs, "payload"), "media")).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
