"""BAM files as a Spark data source, by the format's published description: BGZF blocks, binary records, a BAI index.

A file must be indexed and sorted by coordinate. Its index tells places where records begin, so a file is cut there into parts of
about ``SPLIT_BYTES`` that are read in parallel, each by its own ranges of the file; with a region only the parts that the
index has for it are read. Paths are opened by Arrow's file systems on the driver and the executors.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from strandmark.schema import READ_SCHEMA

SPLIT_BYTES = 64 << 20
BATCH_ROWS = 16_384
NAME = "strandmark_bam"
# Fixed values of the format: CIGAR operations by number, those that move along the reference, sizes of a tag's value.
OPERATIONS = "MIDNSHP=X"
MOVING = (0, 2, 3, 7, 8)
VALUE_FORMATS = {"A": "<c", "c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}


def _system(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path) if "://" in path else (pa.fs.LocalFileSystem(), path)


def _exists(path: str) -> bool:
    system, place = _system(path)
    return system.get_file_info(place).type == pa.fs.FileType.File


def opened(path: str) -> pa.NativeFile:
    system, place = _system(path)
    return system.open_input_file(place)


def _inflated(file: pa.NativeFile, at: int) -> tuple[bytes, int]:
    """(content of the block there, where the next one begins); empty at the end of the file."""
    head = file.read_at(18, at)
    if not head:
        return b"", at
    if len(head) < 18 or head[:4] != b"\x1f\x8b\x08\x04" or head[12:16] != b"BC\x02\x00":
        raise ValueError(f"no BGZF block at {at}")
    (size,) = struct.unpack_from("<H", head, 16)
    block = file.read_at(size + 1, at)
    if len(block) != size + 1:
        raise ValueError(f"the block at {at} is cut off")
    content = zlib.decompress(block[18:-8], -15)
    if struct.pack("<II", zlib.crc32(content), len(content)) != block[-8:]:
        raise ValueError(f"checksum of the block at {at} is wrong")
    return content, at + size + 1


class Stream:
    """The inflated bytes from a virtual offset on (a block's place in the file, and a place in its content)."""

    def __init__(self, file: pa.NativeFile, offset: int) -> None:
        self.file = file
        self.block, self.inner = offset >> 16, offset & 0xFFFF
        self.content, self.next = _inflated(file, self.block)

    def offset(self) -> int:
        """Of what is read next; a block's end is the next one's beginning."""
        while self.content and self.inner == len(self.content):
            self.block, self.inner = self.next, 0
            self.content, self.next = _inflated(self.file, self.block)
        return self.block << 16 | self.inner

    def read(self, n: int) -> bytes:
        """n bytes; fewer at the end of the file."""
        out = b""
        while len(out) < n:
            self.offset()
            got = self.content[self.inner : self.inner + n - len(out)]
            if not got:
                # an empty block may stand before others; only nothing at all is the end
                if self.next == self.block:
                    break
                self.block, self.inner = self.next, 0
                self.content, self.next = _inflated(self.file, self.block)
                continue
            out += got
            self.inner += len(got)
        return out


@dataclass(frozen=True)
class Header:
    text: str
    contigs: list[tuple[str, int]]
    first: int

    @property
    def sorted(self) -> bool:
        return any(line.startswith("@HD") and "SO:coordinate" in line.split("\t") for line in self.text.split("\n"))


def header(path: str) -> Header:
    with opened(path) as file:
        stream = Stream(file, 0)
        if stream.read(4) != b"BAM\1":
            raise ValueError(f"{path} isn't a BAM file")
        text = stream.read(struct.unpack("<i", stream.read(4))[0]).rstrip(b"\0").decode()
        contigs = []
        for _ in range(struct.unpack("<i", stream.read(4))[0]):
            name = stream.read(struct.unpack("<i", stream.read(4))[0])[:-1].decode()
            contigs.append((name, struct.unpack("<i", stream.read(4))[0]))
        return Header(text, contigs, stream.offset())


def index_of(path: str) -> str:
    for name in (path + ".bai", path.removesuffix(".bam") + ".bai"):
        if _exists(name):
            return name
    raise ValueError(f"{path} isn't indexed")


def chunks(path: str) -> list[list[tuple[int, int, int]]]:
    """By contig: (bin, first virtual offset, end) of the index."""
    with opened(index_of(path)) as file:
        data = file.read()
    if data[:4] != b"BAI\1":
        raise ValueError(f"{path}: not an index")
    (n,), at, out = struct.unpack_from("<i", data, 4), 8, []
    for _ in range(n):
        own = []
        (bins,) = struct.unpack_from("<i", data, at)
        at += 4
        for _ in range(bins):
            number, count = struct.unpack_from("<Ii", data, at)
            at += 8
            if number != 37450:  # that one holds counts
                own += [(number, *struct.unpack_from("<QQ", data, at + 16 * k)) for k in range(count)]
            at += 16 * count
        (windows,) = struct.unpack_from("<i", data, at)
        at += 4 + 8 * windows
        out.append(own)
    return out


def bins_over(start: int, end: int) -> set[int]:
    """The index's bins that hold what overlaps [start, end): one bin of 512 Mb, then bins of an eighth each time."""
    out, first = {0}, 1
    for shift in (26, 23, 20, 17, 14):
        out |= set(range(first + (start >> shift), first + (end - 1 >> shift) + 1))
        first += 1 << 29 - shift
    return out


def check(path: str) -> Header:
    """The header; ValueError unless the file is indexed and sorted by coordinate."""
    found = header(path)
    index_of(path)
    if not found.sorted:
        raise ValueError(f"{path} isn't sorted by coordinate")
    return found


def ranges(path: str, found: Header, region: tuple[str, int, int] | None = None, split_bytes: int = SPLIT_BYTES) -> list[tuple[int, int]]:
    """(first virtual offset, end) of the parts, in the file's order; an end of 0 is the file's."""
    by_contig = chunks(path)
    if region is None:
        begins = sorted({b for own in by_contig for _, b, _ in own if b > found.first})
        cuts = [found.first]
        for b in begins:
            if (b >> 16) - (cuts[-1] >> 16) >= split_bytes:
                cuts.append(b)
        return list(zip(cuts, [*cuts[1:], 0]))
    contig, start, end = region
    names = [c for c, _ in found.contigs]
    if contig not in names:
        raise ValueError(f"no contig {contig!r}")
    wanted = bins_over(start, max(end, start + 1))
    own = sorted((b, e) for number, b, e in by_contig[names.index(contig)] if number in wanted)
    merged: list[tuple[int, int]] = []
    for b, e in own:
        if merged and b <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], e))
        else:
            merged.append((b, e))
    return merged


def _nm(data: bytes, at: int) -> int | None:
    while at + 3 <= len(data):
        tag, kind = data[at : at + 2], chr(data[at + 2])
        at += 3
        if kind in "ZH":
            at = data.index(b"\0", at) + 1
        elif kind == "B":
            count = struct.unpack_from("<i", data, at + 1)[0]
            at += 5 + count * struct.calcsize(VALUE_FORMATS[chr(data[at])])
        else:
            if tag == b"NM":
                return struct.unpack_from(VALUE_FORMATS[kind], data, at)[0]
            at += struct.calcsize(VALUE_FORMATS[kind])
    return None


def record(data: bytes, names: list[str]) -> tuple:
    """(query_name, flag, contig, reference_start, reference_end, mapping_quality, cigar, nm)."""
    ref, pos, name_size, mapq, _, operations, flag, bases = struct.unpack_from("<iiBBHHHi", data)
    at = 32 + name_size
    cigar = struct.unpack_from(f"<{operations}I", data, at)
    end = pos + sum(c >> 4 for c in cigar if c & 15 in MOVING)
    text = "".join(f"{c >> 4}{OPERATIONS[c & 15]}" for c in cigar) or "*"
    return data[32 : at - 1].decode(), flag, names[ref] if ref >= 0 else "*", pos, end, mapq, text, _nm(data, at + 4 * operations + (bases + 1) // 2 + bases)


@dataclass
class Part(InputPartition):
    first: int
    end: int


class Reader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path = options["path"]
        region = options.get("contig")
        self.region = (region, int(options.get("start", 0)), int(options.get("end", 1 << 29))) if region else None
        self.split_bytes = int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self) -> list[Part]:
        return [Part(a, b) for a, b in ranges(self.path, check(self.path), self.region, self.split_bytes)]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        names = [c for c, _ in header(self.path).contigs]
        columns = [f.split()[0] for f in READ_SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int32()]
        rows: list[tuple] = []
        with opened(self.path) as file:
            stream = Stream(file, part.first)
            while True:
                offset = stream.offset()
                if part.end and offset >= part.end:
                    break
                size = stream.read(4)
                if not size:
                    break
                row = record(stream.read(struct.unpack("<i", size)[0]), names)
                if self.region is None or row[2] == self.region[0] and row[3] < self.region[2] and max(row[4], row[3] + 1) > self.region[1]:
                    rows.append((offset, *row))
                if len(rows) == BATCH_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], columns)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], columns)


class Source(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options)


def bam(spark: SparkSession, path: str, region: tuple[str, int, int] | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Aligned reads of a BAM file; read_ord is a record's virtual offset. region: only what overlaps (contig, start, end)."""
    check(path)
    spark.dataSource.register(Source)
    reader = spark.read.format(NAME).option("splitBytes", split_bytes)
    for key, value in zip(("contig", "start", "end"), region or ()):
        reader = reader.option(key, value)
    return reader.load(path)


def bam_contigs(spark: SparkSession, path: str) -> DataFrame:
    """(contig, length, ordinal) of the header."""
    return spark.createDataFrame([(c, n, k) for k, (c, n) in enumerate(header(path).contigs)], "contig string, length long, ordinal long")
