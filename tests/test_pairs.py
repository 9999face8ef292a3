"""Mates and duplicates against a plain walk over templates."""

import random
import re

from util import frame, read

from strandmark.operators import sites


def clipped(cigar, side):
    m = re.search(r"^(\d+[SH])+" if side == "head" else r"(\d+[SH])+$", cigar)
    return sum(map(int, re.findall(r"\d+", m[0]))) if m else 0


def end_of(r):
    return r.reference_end - 1 + clipped(r.cigar, "tail") if r.flag & 16 else r.reference_start - clipped(r.cigar, "head")


def test_all_clips_count(spark):
    rows = [read(100, cigar="5H3S50M", name="a"), read(97, cigar="5S53M", name="b"), read(100, cigar="8S50M", name="c"), read(100, cigar="50M", name="d")]
    rows += [read(200, flag=17, cigar="50M2S3H", name="e"), read(200, flag=17, cigar="55M", name="f"), read(200, flag=17, cigar="50M", name="g")]
    marked = {r.query_name: bool(r.flag & 1024) for r in sites.mark_duplicates(frame(spark, rows)).collect()}
    assert sum(marked[n] for n in "abc") == 2 and sum(marked[n] for n in "ef") == 1 and not marked["d"] and not marked["g"]


def test_pairs_against_a_walk(spark):
    rng = random.Random(6)
    rows = []
    for k in range(250):
        kind = rng.choice(["pair", "pair", "pair", "single", "half", "alone", "supplementary"])
        one = [rng.choice([100, 101, 400]), rng.choice([0, 16]), rng.choice(["50M", "3H2S50M", "5S50M", "50M5S"])]
        two = [rng.choice([300, 302]), rng.choice([0, 16]), rng.choice(["50M", "50M4S1H"])]
        flags = {"single": [0], "half": [65 | 8, 129 | 4], "alone": [65], "supplementary": [65, 129, 65 | 2048]}.get(kind, [65, 129])
        for flag, (at, back, cigar) in zip(flags, (one, two, one)):
            rows.append(read(at, flag=flag | back, cigar=cigar, mapq=rng.randint(0, 5), contig=rng.choice(["chr1", "chr1", "chr2"]), name=f"t{k}"))
    rows += [read(100, flag=65, name="same"), read(101, flag=65, name="same"), read(300, flag=129, name="same")]
    rng.shuffle(rows)
    reads = frame(spark, rows).collect()
    fixed = {r.read_ord: r for r in sites.fixmate(frame(spark, rows)).collect()}
    marked = {r.read_ord: r for r in sites.mark_duplicates(spark.createDataFrame(list(fixed.values()), sites.fixmate(frame(spark, rows)).schema)).collect()}
    assert sorted(fixed) == sorted(marked) == sorted(r.read_ord for r in reads)
    side = {}
    for r in sorted(reads, key=lambda r: r.read_ord):
        if r.flag & 1 and not r.flag & 2304:
            side.setdefault((r.query_name, r.flag & 192), r)
    mate = {}
    for r in reads:
        m = side.get((r.query_name, 192 - (r.flag & 192))) if r.flag & 1 else None
        mate[r.read_ord] = m if m and not m.flag & 4 else None
        f = fixed[r.read_ord]
        want = (m.contig, m.reference_start, bool(m.flag & 16), end_of(m), m.mapping_quality, m.read_ord) if mate[r.read_ord] else (None,) * 6
        assert tuple(f[c] for c in sites.FIXED) == want
        if m:
            assert bool(f.flag & 8) == bool(m.flag & 4) and bool(f.flag & 32) == bool(not m.flag & 4 and m.flag & 16)
    groups, ends = {}, set()
    for r in reads:
        if not r.flag & (4 | 2304):
            m, here = mate[r.read_ord], (r.contig, r.flag & 16, end_of(r))
            groups.setdefault((here, m and (m.contig, m.flag & 16, end_of(m))), []).append(r)
            ends |= {here} if m else set()
    want = {}
    for (here, other), own in groups.items():
        rank = lambda r: (-(r.mapping_quality + (mate[r.read_ord].mapping_quality if other else 0)), min(r.read_ord, mate[r.read_ord].read_ord) if other else r.read_ord)  # noqa: B023, E731
        for k, r in enumerate(sorted(own, key=rank)):
            want[r.read_ord] = k > 0 or (other is None and here in ends)
    assert all(bool(marked[r.read_ord].flag & 1024) == want.get(r.read_ord, False) for r in reads)
    # both mates of a plain pair stay or go
    for k in range(250):
        own = [r for r in reads if r.query_name == f"t{k}"]
        if len(own) == 2 and all(mate[r.read_ord] for r in own):
            assert len({bool(marked[r.read_ord].flag & 1024) for r in own}) == 1
