"""BAM files written by hand: blocks that records go across, an index, regions."""

import random
import struct
import zlib

import pytest

from strandmark.operators import sites
from strandmark.sources import bam, formats

CONTIGS = [("chr1", 300_000), ("chr2", 50_000)]


def bgzf(data, size):
    blocks, places = [], []
    at = 0
    for k in [*range(0, len(data), size), len(data)]:
        part = data[k : k + size]
        engine = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = engine.compress(part) + engine.flush()
        block = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part))
        places.append(at)
        blocks.append(block)
        at += len(block)
    return b"".join(blocks), places


def record(name, flag, ref, pos, mapq, cigar, tags):
    ops = [(int(n), bam.OPERATIONS.index(o)) for n, o in cigar]
    bases = sum(n for n, o in ops if o in (0, 1, 4, 7, 8))
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, mapq, 0, len(ops), flag, bases, -1, -1, 0)
    body += name.encode() + b"\0" + b"".join(struct.pack("<I", n << 4 | o) for n, o in ops) + b"\x11" * ((bases + 1) // 2) + b"\x1e" * bases + tags
    return struct.pack("<i", len(body)) + body


def bin_of(start, end):
    for shift, first in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)):
        if start >> shift == end - 1 >> shift:
            return first + (start >> shift)
    return 0


def put(path, rows, size=700, order="coordinate", index=True):
    """Writes rows (name, flag, ref, pos, mapq, cigar, tags) and returns what should be read."""
    text = f"@HD\tVN:1.6\tSO:{order}\n".encode()
    data = b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(CONTIGS)) + b"".join(struct.pack("<i", len(c) + 1) + c.encode() + b"\0" + struct.pack("<i", n) for c, n in CONTIGS)
    starts = []
    for r in rows:
        starts.append(len(data))
        data += record(*r)
    whole, places = bgzf(data, size)
    path.write_bytes(whole)
    virtual = lambda k: places[k // size] << 16 | k % size
    ends = [*starts[1:], len(data)]
    by_ref = [{} for _ in CONTIGS]
    for (_, _, ref, pos, _, cigar, _), a, b in zip(rows, starts, ends):
        if ref >= 0:
            end = pos + max(1, sum(int(n) for n, o in cigar if o in "MDN=X"))
            by_ref[ref].setdefault(bin_of(pos, end), []).append((virtual(a), virtual(b)))
    out = b"BAI\1" + struct.pack("<i", len(CONTIGS))
    for own in by_ref:
        out += struct.pack("<i", len(own) + 1) + struct.pack("<IiQQQQ", 37450, 2, 0, 0, 0, 0)
        for number, parts in own.items():
            out += struct.pack("<Ii", number, len(parts)) + b"".join(struct.pack("<QQ", *p) for p in parts)
        out += struct.pack("<i", 1) + struct.pack("<Q", 0)
    if index:
        path.with_name(path.name + ".bai").write_bytes(out)
    return [virtual(a) for a in starts]


def made(n=900):
    rng = random.Random(4)
    rows = []
    for k in range(n):
        ref = int(k >= 2 * n // 3)
        cigar = rng.choice([[("50", "M")], [("5", "S"), ("40", "M")], [("10", "M"), ("3", "D"), ("20", "M"), ("2", "I"), ("5", "M")], [("20", "M"), ("20000", "N"), ("10", "M")]])
        tags = rng.choice([b"", b"NMC\x07", b"XZZabc\0NMi" + struct.pack("<i", 300), b"ABBS" + struct.pack("<iHH", 2, 1, 2) + b"NMc\x01", b"XFf\0\0\0\0"])
        rows.append((f"read{k}" * rng.randrange(1, 4), rng.choice([0, 16, 256, 1024]), ref, rng.randrange(0, CONTIGS[ref][1] - 100), rng.randrange(61), cigar, tags))
    rows.sort(key=lambda r: (r[2], r[3]))
    return [*rows, ("nowhere", 4, -1, -1, 0, [], b"")]


def expected(rows, offsets):
    nm = {b"": None, b"NMC\x07": 7, b"XZ": 300, b"AB": 1, b"XF": None}
    names = [c for c, _ in CONTIGS] + ["*"]
    out = []
    for (name, flag, ref, pos, mapq, cigar, tags), o in zip(rows, offsets):
        end = pos + sum(int(n) for n, k in cigar if k in "MDN=X")
        out.append((o, name, flag, names[ref], pos, end, mapq, "".join(a + b for a, b in cigar) or "*", nm.get(tags, nm.get(tags[:2]))))
    return out


def test_reads_in_parts(spark, tmp_path):
    rows = made()
    for size in (97, 700, 60_000):
        path = tmp_path / f"{size}.bam"
        want = expected(rows, put(path, rows, size))
        for split in (1, 3000, bam.SPLIT_BYTES):
            df = bam.bam(spark, str(path), split_bytes=split)
            assert sorted(map(tuple, df.collect())) == want
        assert len(bam.ranges(str(path), bam.header(str(path)), None, 1)) > (1 if size < 60_000 else 0)
    assert [tuple(r) for r in bam.bam_contigs(spark, str(path)).orderBy("ordinal").collect()] == [(c, n, k) for k, (c, n) in enumerate(CONTIGS)]
    assert sites.contig_density(bam.bam(spark, "file://" + str(path))).count() == 2
    formats.same_contigs(bam.bam_contigs(spark, str(path)), bam.bam_contigs(spark, str(path)))


def test_regions_use_the_index(spark, tmp_path):
    rows = made()
    path = tmp_path / "a.bam"
    whole = expected(rows, put(path, rows))
    for region in (("chr1", 1000, 1001), ("chr1", 0, 300_000), ("chr2", 20_000, 26_000), ("chr1", 150_000, 150_500)):
        want = [r for r in whole if r[3] == region[0] and r[4] < region[2] and r[5] > region[1]]
        assert sorted(map(tuple, bam.bam(spark, str(path), region).collect())) == want
    head = bam.header(str(path))
    part = bam.ranges(str(path), head, ("chr2", 20_000, 20_100))
    assert sum((b >> 16) - (a >> 16) for a, b in part) < path.stat().st_size / 3
    with pytest.raises(Exception, match="no contig"):
        bam.bam(spark, str(path), ("chr9", 0, 5)).collect()


def test_preconditions(spark, tmp_path):
    rows = made(20)
    put(tmp_path / "plain.bam", rows, index=False)
    with pytest.raises(ValueError, match="isn't indexed"):
        bam.bam(spark, str(tmp_path / "plain.bam"))
    put(tmp_path / "names.bam", rows, order="queryname")
    with pytest.raises(ValueError, match="isn't sorted"):
        bam.bam(spark, str(tmp_path / "names.bam"))
    (tmp_path / "x.bam").write_bytes(b"no blocks at all, but some bytes")
    with pytest.raises(ValueError, match="no BGZF block"):
        bam.header(str(tmp_path / "x.bam"))
    put(tmp_path / "a.bam", rows)
    data = bytearray((tmp_path / "a.bam").read_bytes())
    data[40] ^= 255
    (tmp_path / "a.bam").write_bytes(data)
    with pytest.raises((ValueError, zlib.error)):
        bam.header(str(tmp_path / "a.bam"))
    put(tmp_path / "none.bam", [])
    assert bam.bam(spark, str(tmp_path / "none.bam")).count() == 0
