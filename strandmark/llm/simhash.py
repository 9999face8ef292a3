"""Operator 8: SimHash near-dedup by multi-index hashing.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; shingles of ``width`` words, repeats included
(fewer words: the whole sequence), are hashed with XXH64, seed 42. A fingerprint bit is 1 if it's set in over half
the hashes; without words the fingerprint is zero.

Links within ``DISTANCE`` = 2 bits. Multi-index hashing: a fingerprint has one row in the table for each of its two
32-bit segments, addressed by the segment's value. Two fingerprints at most 2 bits apart differ by at most one bit in one
of the segments, so each fingerprint enumerates the radius-1 ball around each of its segments (only bits that are 0 are
set: of two values one bit apart one finds the other), fetches the fingerprints that the table has there, and the complete
distance is verified. Segment values that more than ``HOT`` fingerprints share are split: there the other half is
indexed the same way by its two 16-bit segments, so an address holds at most 65,536 distinct fingerprints however
skewed the input is. Only verified links leave the join.

Equal fingerprints are one node before anything is enumerated, so thousands of copies cost one row.

``near_groups`` and ``keep_one`` find near copies of a given Jaccard similarity of the sets of distinct shingles (0.8
and five words by default). Fingerprints, here of 256 bits or more over distinct shingles, only name candidates. Segments
widen with the logarithm of the number of documents, so that an address holds about as many at every size, and there are
so many of them that a pair at the similarity asked for shares an address in all but ``MISSED`` of cases (``Shape``). Balls
have radius 1 on both sides: pairs within 2 bits in some segment meet. A fingerprint is sent a few times for each segment, by
blocks of the segment's bits (``routes``), and its balls are enumerated where it arrives. A link is what the shingle sets themselves confirm.
This goes in two rounds: a quarter of the segments first; what they connect is one component from then on, and the other
segments only name pairs between components, so a large group of near copies does not name its pairs again and again.
Addresses that a bounded sample shows to hold more than ``CROWD`` documents are dealt over several tasks; in the second
round the members of the address's largest component are dealt, and all its others go to each of these tasks.

Edge cases: null text is empty; texts without words share fingerprint zero and are linked like any other; repeated
rows and ids are kept as rows of their own; rows with a null id take part but are never a component's id unless all
ids in it are null; other columns are carried by ``keep_one``; no documents give no rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import base

DISTANCE = 2
SEED = 42
#: Distinct fingerprints of a segment value beyond which it is split by the other half.
HOT = 4096
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))


def shingle_hashes(text: str | None, width: int) -> list[int]:
    norm = b" ".join((text or "").encode().translate(_FOLD).split())
    if not norm:
        return []
    blanks = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32)
    if len(blanks) + 1 < width:
        return [xxhash.xxh64_intdigest(norm, SEED)]
    starts = [0, *(blanks + 1).tolist()]
    ends = [*blanks.tolist(), len(norm)]
    digest = xxhash.xxh64_intdigest
    return [digest(norm[a:b], SEED) for a, b in zip(starts, ends[width - 1 :])]


def fingerprint(text: str | None, width: int = 3) -> int:
    """Unsigned."""
    hashes = shingle_hashes(text, width)
    if not hashes:
        return 0
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_in = bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * set_in > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): fp is the fingerprint as a signed long."""
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base.forget()
            values = np.array([fingerprint(t.as_py(), width) for t in batch.column(1)], np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {id_type.simpleString()}, fp long")


def _ball(address: str, bits: int) -> Column:
    """The address and those with one more of its lowest bits set."""
    clear = f"filter(sequence(0, {bits - 1}), i -> (shiftright({address}, i) & 1L) = 0L)"
    return F.expr(f"concat(array({address}), transform({clear}, i -> {address} | shiftleft(1L, i)))")


def _verified(probes: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """(a, b) of what the probes fetch from the table, within DISTANCE."""
    homes = table.select(F.col("fp").alias("b"), *[F.col(k).alias(f"_{k}") for k in keys])
    met = (F.col("fp") != F.col("b")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= DISTANCE)
    for k in keys:
        met = met & (F.col(k) == F.col(f"_{k}"))
    return probes.join(homes, met).select(F.greatest("fp", "b").alias("a"), F.least("fp", "b").alias("b"))


def links(fps: DataFrame, hot: int | None = None) -> DataFrame:
    """(a, b), a > b: all pairs of distinct fingerprints ``fps(fp)`` within DISTANCE bits."""
    # few bytes become many rows: as many tasks as there are partitions, whatever the size of the table
    fps = fps.repartition(base.partitions_for(fps.sparkSession), "fp")
    segments = F.array(*[F.struct(F.lit(k).alias("segment"), F.expr(f"shiftrightunsigned(fp, {32 * k}) & 4294967295L | {k << 32}L").alias("address")) for k in range(2)])
    table = fps.select("fp", F.explode(segments).alias("s")).select("fp", "s.segment", "s.address")
    probes = table.select("fp", "segment", F.explode(_ball("address", 32)).alias("address"))
    crowded = base.written(table.groupBy("address").count().where(F.col("count") > (HOT if hot is None else hot)).select("address"), "crowded")
    if crowded.isEmpty():
        return _verified(probes, table, ["address"]).distinct()
    plain = [df.join(crowded, "address", "left_anti") for df in (probes, table)]
    split = []
    for df in (probes, table):
        own = df.join(crowded, "address", "left_semi").withColumn("other", F.expr("shiftrightunsigned(fp, 32 * (1 - segment)) & 4294967295L"))
        inner = F.explode(F.expr("array(other & 65535L, shiftrightunsigned(other, 16) | 65536L)")).alias("inner")
        split.append(own.select("fp", "address", inner))
    split[0] = split[0].select("fp", "address", F.explode(_ball("inner", 16)).alias("inner"))
    return _verified(*plain, ["address"]).union(_verified(*split, ["address", "inner"])).distinct()


def components(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id): the smallest id reachable through links, the row's own included."""
    marks = base.written(fingerprints(docs, width, id_col, text_col), "fingerprints")
    nodes = base.written(marks.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    roots = base.connected_components(links(nodes.select("fp"))).select(F.col("node").alias("fp"), "root")
    rooted = nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return marks.join(rooted.join(smallest, "root").select("fp", "component_id"), "fp").select("id", "fp", "component_id")


#: Bits at least of the wide fingerprints of near copies.
WIDE_BITS = 256
#: Pairs at the similarity asked for that share no address.
MISSED = 0.002
#: Pairs within so many of 256 bits are linked as soon as they are seen, those further apart by nearness.
CLOSE_BITS = 24
#: Documents of an address beyond which it is dealt over tasks, and at least of the sample that shows it.
CROWD, SAMPLE = 8192, 20_000
#: Bytes of entries that meet in one group.
GROUP_BYTES = 4 << 20
#: Bytes of entries beyond which a place that they are sent to is cut.
PLACE_BYTES = 16 << 20


@dataclass(frozen=True)
class Shape:
    """A wide fingerprint: ``segments`` of ``width`` bits are indexed, ``bits`` in all; a candidate differs in ``most``."""

    width: int
    segments: int
    bits: int
    most: int

    @staticmethod
    def of(documents: int, similarity: float) -> Shape:
        p = math.acos(2 * similarity / (1 + similarity)) / math.pi  # of a bit to differ, between two equally large sets
        width = max(16, math.ceil(math.log2(max(2, documents))) - 2)
        meet = sum(math.comb(width, k) * p**k * (1 - p) ** (width - k) for k in range(3))
        segments = math.ceil(math.log(MISSED) / math.log(1 - meet))
        bits = max(WIDE_BITS, 64 * -(-width * segments // 64))
        return Shape(width, segments, bits, math.ceil(bits * p + 3 * math.sqrt(bits * p * (1 - p))))

    @property
    def close(self) -> int:
        return CLOSE_BITS * self.bits // 256


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The hashes of the distinct shingles, ascending."""
    return np.unique(np.array(shingle_hashes(text, width), "<u8"))


def wide_fingerprint(hashes: np.ndarray, bits: int = WIDE_BITS) -> bytes:
    """A fingerprint of so many bits of a shingle set: each hash goes through a mixer for each 64 bits."""
    if not len(hashes):
        return bytes(bits // 8)
    salts = np.arange(1, bits // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
    set_in = np.zeros(bits, np.int64)
    for k in range(0, len(hashes), 4096):
        h = hashes[k : k + 4096, None] * salts
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(29)
        set_in += np.unpackbits(h.view(np.uint8).reshape(-1, bits // 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return np.packbits(2 * set_in > len(hashes), bitorder="little").tobytes()


def _node(hashes: np.ndarray) -> int:
    """A shingle set's number (signed)."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).astype(np.int64))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two ascending arrays of distinct hashes."""
    both = np.sort(np.concatenate((a, b)), kind="stable")
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared / max(1, len(both) - shared)


def _values(words: np.ndarray, width: int, segments: np.ndarray) -> np.ndarray:
    """The value of a segment of each fingerprint: ``segments`` has one for each, or is a single one for all."""
    word, shift = np.divmod(np.broadcast_to(segments, len(words)) * width, 64)
    every = np.arange(len(words))
    above = words[every, np.minimum(word + 1, words.shape[1] - 1)]
    value = words[every, word] >> shift.astype(np.uint64)
    # a shift by 64 has no meaning, so by one and then the rest; bits above the segment are cut off
    value |= np.where(shift + width > 64, above << np.uint64(1) << (63 - shift).astype(np.uint64), np.uint64(0))
    return value & np.uint64((1 << width) - 1)


def _ball_of(free: int, width: int) -> np.ndarray:
    """0 and each bit of ``free``."""
    return np.array([0, *(1 << b for b in range(width) if free >> b & 1)], np.uint64)


def _addresses(words: np.ndarray, width: int, segments: range) -> np.ndarray:
    """(segment, value) addresses of each fingerprint: the radius-1 ball of each of these segments."""
    flips = _ball_of((1 << width) - 1, width)
    out = [(_values(words, width, np.int64(k))[:, None] ^ flips) | np.uint64(k << width) for k in segments]
    return np.concatenate(out, axis=1)


def routes(total: int, size: int, width: int) -> list[int]:
    """Masks of a segment's bits by which entries of ``size`` bytes are sent.

    A segment is cut into blocks. Values within 2 bits agree in all blocks but two, so where a fingerprint goes once for each choice
    of all blocks but two, with their bits as the place to go to, such values meet. There are as few blocks as keep a place's share
    of all entries below half of PLACE_BYTES: three up to some 10^7 documents.
    """
    masks: list[int] = []
    for n in range(3, width + 1):
        cuts = [width * k // n for k in range(n + 1)]
        blocks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
        masks = [sum(chosen) for chosen in itertools.combinations(blocks, n - 2)]
        if total * size >> min(m.bit_count() for m in masks) <= PLACE_BYTES // 2:
            break
    return masks


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(33))


def _linked(ids: np.ndarray, labels: np.ndarray, words: np.ndarray, shape: Shape) -> list[tuple[int, int]]:
    """Candidates (a, b) that connect what pairs within ``most`` bits connect, by the nearest pairs between labels. One that isn't confirmed may
    hide others that would be, so this serves a first round, behind which all pairs meet. Each step takes the member nearest to those reached, and with it all of its label and those close to it."""
    out = []
    open_ = np.arange(len(ids))
    distance, source = np.full(len(ids), shape.bits + 1), np.zeros(len(ids), np.int64)
    queue: list[int] = []
    while len(open_):
        if queue:
            k = queue.pop()
        else:
            at = int(distance[open_].argmin())
            k = int(open_[at])
            if distance[k] <= shape.most:
                out.append((int(ids[k]), int(ids[source[k]])))
            open_ = np.delete(open_, at)
        if not len(open_):
            break
        bits = np.bitwise_count(words[open_] ^ words[k]).sum(axis=1, dtype=np.int64)
        nearer = bits < distance[open_]
        distance[open_[nearer]], source[open_[nearer]] = bits[nearer], k
        own = labels[open_] == labels[k]
        close = (bits <= shape.close) & ~own
        if close.any():  # one of each label, the others come with it
            _, first = np.unique(labels[open_[close]], return_index=True)
            taken = open_[close][first]
            out += [(int(ids[r]), int(ids[k])) for r in taken]
            own |= np.isin(open_, taken, assume_unique=True)
        if own.any():
            queue += open_[own].tolist()
            open_ = open_[~own]
    return out


def _distinct(pairs: list[np.ndarray]) -> np.ndarray:
    """Rows (a, b), a > b, each once."""
    both = np.concatenate([np.empty((0, 2), np.int64), *pairs])
    both = np.stack((both.max(axis=1), both.min(axis=1)), axis=1) if len(both) else both
    both = both[np.lexsort((both[:, 1], both[:, 0]))]
    return both[np.append(True, (both[1:] != both[:-1]).any(axis=1))] if len(both) else both


def _every(address: np.ndarray, at: np.ndarray, ids: np.ndarray, labels: np.ndarray, words: np.ndarray, shape: Shape) -> np.ndarray:
    """All pairs of different labels within ``most`` bits, of sorted addresses; ``at`` as in ``_named``."""
    heads = np.flatnonzero(np.append(True, address[1:] != address[:-1]))
    end = np.repeat(np.append(heads[1:], len(address)), np.diff(np.append(heads, len(address))))
    p, step, held = np.arange(len(address)), 0, 0
    found: list[np.ndarray] = []
    while len(p):
        step += 1
        p = p[p + step < end[p]]
        for a in range(0, len(p), 1 << 18):
            q = p[a : a + (1 << 18)]
            r, t = at[q], at[q + step]
            some = np.flatnonzero(labels[r] != labels[t])
            r, t = r[some], t[some]
            near = np.bitwise_count(words[r] ^ words[t]).sum(axis=1, dtype=np.int64) <= shape.most
            found.append(np.stack((ids[r[near]], ids[t[near]]), axis=1))
            held += len(found[-1])
            if held > 1 << 20:  # a pair shares many addresses
                found = [_distinct(found)]
                held = 0
    return _distinct(found)


def _named(address: np.ndarray, at: np.ndarray, ids: np.ndarray, labels: np.ndarray, words: np.ndarray, shape: Shape, whole: bool = False) -> np.ndarray:
    """Candidates of sorted addresses; ``at`` are the rows of ids, labels and fingerprints that lie there. ``whole``: all of them."""
    if whole:
        return _every(address, at, ids, labels, words, shape)
    heads = np.flatnonzero(np.append(True, address[1:] != address[:-1]))
    ends = np.append(heads[1:], len(address))
    sizes = ends - heads
    # members of the many small addresses that have anything near are found pair by pair, at once for all addresses
    hit = np.repeat(sizes > 1024, sizes)
    end = np.repeat(ends, sizes)
    p, step = np.flatnonzero(~hit), 0
    while len(p):
        step += 1
        p = p[p + step < end[p]]
        for a in range(0, len(p), 1 << 18):
            q = p[a : a + (1 << 18)]
            r, t = at[q], at[q + step]
            near = (np.bitwise_count(words[r] ^ words[t]).sum(axis=1, dtype=np.int64) <= shape.most) & (labels[r] != labels[t])
            hit[q[near]] = hit[q[near] + step] = True
    some = np.flatnonzero(hit)
    cut = np.flatnonzero(address[some][1:] != address[some][:-1]) + 1
    found: set[tuple[int, int]] = set()
    for part in np.split(at[some], cut) if len(some) else []:
        found.update(_linked(ids[part], labels[part], words[part], shape))
    return _distinct([np.array(sorted(found), np.int64).reshape(-1, 2)])


def _sample(nodes: DataFrame, total: int) -> tuple[DataFrame, float]:
    """(label, fp) of a share of the nodes, chosen by hash and written, and how many nodes one stands for. It grows with the nodes,
    so that CROWD of them show at any size."""
    rows = max(SAMPLE, 8 * total // CROWD)
    share = -(1 << 63) + min((1 << 64) - 1, (rows << 64) // total)
    sample = base.written(nodes.where(F.xxhash64("node", F.lit("sample")) <= F.lit(share)).select("label", "fp"), "crowd-sample")
    return sample, total / max(1, sample.count())


def _crowds(nodes: DataFrame, total: int, shape: Shape, segments: range) -> dict[int, tuple[int, int, int]]:
    """Of addresses that hold more than CROWD nodes by a sample: (parts of the others, parts of the most frequent label, that
    label). The sample is counted on the executors."""
    if total <= CROWD:
        return {}
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                base.forget()
                raw = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                address = _addresses(raw.copy().view("<u8"), shape.width, segments)
                yield pa.RecordBatch.from_arrays([pa.array(address.ravel().astype(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(), address.shape[1]))], ["address", "label"])

    sample, times = _sample(nodes, total)
    by_label = sample.mapInArrow(spread, "address long, label long").groupBy("address", "label").agg(F.count("*").alias("n"))
    found = by_label.groupBy("address").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("most"))
    large = found.where((F.col("n") >= 8) & (F.col("n") * times > CROWD)).collect()  # at most the entries by CROWD
    base.discard(sample)
    out = {}
    for r in large:
        most, others = r.most.n * times, (r.n - r.most.n) * times
        part = max(CROWD, (most + others) / 700)
        out[r.address] = (max(1, math.ceil(others / part)), max(1, math.ceil(most / part)), r.most.label)
    return out


@dataclass(frozen=True)
class Places:
    """Where fingerprints of a round are sent: one entry for each segment and mask, at the bits of the mask; a place that holds more than
    PLACE_BYTES by the sample is cut into pieces, by the addresses that lie in it."""

    width: int
    segments: range
    masks: list[int]
    groups: int
    heavy: np.ndarray
    pieces: np.ndarray

    @property
    def tags(self) -> int:
        """Of segments and masks: a number each, segment * len(masks) + mask."""
        return self.segments.stop * len(self.masks)

    def of(self, values: np.ndarray, tags: np.ndarray) -> np.ndarray:
        masks = np.array(self.masks, np.uint64)[tags % len(self.masks)]
        return tags.astype(np.uint64) << np.uint64(self.width) | values & masks

    def cut(self, place: np.ndarray) -> np.ndarray:
        """In how many pieces each place is."""
        if not len(self.heavy):
            return np.ones(len(place), np.uint64)
        k = np.minimum(np.searchsorted(self.heavy, place), len(self.heavy) - 1)
        return np.where(self.heavy[k] == place, self.pieces[k], np.uint64(1))

    def balls(self, values: np.ndarray, tags: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, addresses) by mask: the radius-1 balls in the bits that the mask leaves free."""
        for k, mask in enumerate(self.masks):
            rows = np.flatnonzero(tags % len(self.masks) == k)
            flips = _ball_of(~mask & (1 << self.width) - 1, self.width)
            yield rows, (values[rows, None] ^ flips) | (tags[rows, None].astype(np.uint64) << np.uint64(self.width))

    def groups_of(self, place: np.ndarray, piece: np.ndarray) -> np.ndarray:
        return (_mixed(_mixed(place) + piece) % np.uint64(self.groups)).astype(np.int64)

    def groups_of_addresses(self, place: np.ndarray, cut: np.ndarray, address: np.ndarray) -> np.ndarray:
        return self.groups_of(place[:, None], _mixed(address) % cut[:, None])


def _heavy(nodes: DataFrame, total: int, size: int, width: int, segments: range, masks: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Places that hold more than PLACE_BYTES by a sample, ascending, and in how many pieces they are to be cut."""
    none = np.zeros(0, np.uint64)
    if total * size <= PLACE_BYTES:
        return none, none
    plain = Places(width, segments, masks, 1, none, none)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tags = np.arange(segments.start * len(masks), plain.tags)
        for batch in batches:
            base.forget()
            words = _words(batch.column(1))
            for tag in tags:
                place = plain.of(_values(words, width, np.int64(tag // len(masks))), np.full(len(words), tag))
                yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int64))], ["place"])

    sample, times = _sample(nodes, total)
    counts = sample.mapInArrow(spread, "place long").groupBy("place").agg(F.count("*").alias("n"))
    # at most all entries' bytes by PLACE_BYTES
    found = sorted((r.place, math.ceil(r.n * times * size / PLACE_BYTES)) for r in counts.where((F.col("n") >= 8) & (F.col("n") * times * size > PLACE_BYTES)).collect())
    base.discard(sample)
    return np.array([p for p, _ in found], np.uint64), np.array([n for _, n in found], np.uint64)


def _words(column: pa.Array) -> np.ndarray:
    """Fingerprints as rows of 64-bit words."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(len(column), -1)


def _pairs_table(pairs: np.ndarray) -> pa.Table:
    return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})


def first_segments(shape: Shape) -> int:
    """Segments of the first round, which only joins what is easily found, so that few pairs of different labels are left to the second, of all segments."""
    return -(-shape.segments // 4) if shape.segments <= 16 else -(-shape.segments // 32)


def entry_bytes(shape: Shape, later: bool) -> int:
    """Of an entry: tag, node, in the second round its label, fingerprint."""
    return 2 + 8 + 8 * later + shape.bits // 8


def bytes_a_document(documents: int, similarity: float) -> int:
    """What near-dedup sends of a document in both rounds, where no place is heavy and no address crowded."""
    shape = Shape.of(documents, similarity)
    out = 0
    for segments, later in ((first_segments(shape), False), (shape.segments, True)):
        size = entry_bytes(shape, later)
        out += segments * len(routes(documents, size, shape.width)) * size
    return out


def near_candidates(nodes: DataFrame, shape: Shape, segments: range, again: range = range(0), whole: bool = False) -> DataFrame:
    """(a, b), a > b, of nodes(node, label, fp): candidates of different labels that share an address of these segments; all of them with ``whole``,
    else such as connect what all would, if all were confirmed.

    A fingerprint is sent by ``routes`` and its balls are enumerated where it arrives, so what is sent doesn't grow with the balls.
    Crowded addresses are left out there and dealt over tasks of their own.
    """
    total = nodes.count()
    later = whole or segments.start > 0
    crowds = _crowds(nodes, total, shape, range(segments.start, segments.stop))
    repeated = _crowds(nodes, total, shape, again) if len(again) else {}
    size = entry_bytes(shape, later)
    masks = routes(total, size, shape.width)
    partitions = base.partitions_for(nodes.sparkSession)
    groups = max(partitions, 2 * total * len(segments) * len(masks) * size // GROUP_BYTES)
    places = Places(shape.width, segments, masks, groups, *_heavy(nodes, total, size, shape.width, segments, masks))
    known = np.array(sorted(crowds), np.uint64)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tags = np.arange(segments.start * len(masks), places.tags)
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                base.forget()
                n, words = batch.num_rows, _words(batch.column(2))
                values = np.concatenate([_values(words, shape.width, np.int64(t // len(masks))) for t in tags])
                tag, row = np.repeat(tags, n), np.tile(np.arange(n), len(tags))
                place = places.of(values, tag)
                cut = places.cut(place)
                group = places.groups_of(place, np.zeros(len(place), np.uint64))
                several = np.flatnonzero(cut > 1)
                if len(several):
                    own, to = [], []
                    for rows, address in places.balls(values[several], tag[several]):
                        k = several[rows]
                        g = np.sort(places.groups_of_addresses(place[k], cut[k], address), axis=1)
                        new = np.concatenate((np.ones((len(g), 1), bool), g[:, 1:] != g[:, :-1]), axis=1)
                        own.append(np.repeat(k, new.sum(axis=1)))
                        to.append(g[new])
                    at = np.concatenate((np.flatnonzero(cut == 1), *own))
                    group = np.concatenate((group[cut == 1], *to))
                    tag, row = tag[at], row[at]
                order = np.argsort(group, kind="stable")
                group, tag, row = group[order], tag[order], row[order]
                entry = np.empty((len(order), size), np.uint8)
                entry[:, :2] = tag.astype("<u2").view(np.uint8).reshape(-1, 2)
                for k in range(1 + later):
                    entry[:, 2 + 8 * k : 10 + 8 * k] = batch.column(k).to_numpy()[row].astype("<i8").view(np.uint8).reshape(-1, 8)
                entry[:, 10 + 8 * later :] = words.view(np.uint8).reshape(n, -1)[row]
                heads = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
                ends = np.append(heads[1:], len(group))
                yield pa.RecordBatch.from_arrays([pa.array(group[heads]), pa.array([entry[a:b].tobytes() for a, b in zip(heads, ends)], pa.binary())], ["g", "rows"])

    def match(key: tuple, table: pa.Table) -> pa.Table:
        base.forget()
        entry = np.frombuffer(b"".join(table["rows"].to_pylist()), np.uint8).reshape(-1, size)
        tag = np.ascontiguousarray(entry[:, :2]).view("<u2").ravel().astype(np.int64)
        ids, labels = (np.ascontiguousarray(entry[:, a : a + 8]).view("<i8").ravel() for a in (2, 2 + 8 * later))
        words = np.ascontiguousarray(entry[:, 10 + 8 * later :]).view("<u8").reshape(len(entry), -1)
        values = _values(words, shape.width, tag // len(masks))
        place = places.of(values, tag)
        cut = places.cut(place)
        parts, at = [], []
        for rows, address in places.balls(values, tag):
            here = np.ones(address.shape, bool)
            several = np.flatnonzero(cut[rows] > 1)
            if len(several):
                k = rows[several]
                here[several] = places.groups_of_addresses(place[k], cut[k], address[several]) == key[0].as_py()
            if len(known):
                plain = address & np.uint64((1 << shape.width) - 1) | (tag[rows, None] // len(masks)).astype(np.uint64) << np.uint64(shape.width)
                here &= ~np.isin(plain, known)
            parts.append(address[here])
            at.append(np.broadcast_to(rows[:, None], address.shape)[here])
        address, row = np.concatenate(parts), np.concatenate(at)
        order = np.argsort(address, kind="stable")
        return _pairs_table(_named(address[order], row[order], ids, labels, words, shape, whole))

    even = nodes.select("node", "label", "fp").repartition(partitions, "fp")
    found = even.mapInArrow(probe, "g long, rows binary").groupBy("g").applyInArrow(match, "a long, b long")
    if crowds or repeated:
        found = found.union(_dealt_candidates(even, shape, segments, again, crowds, repeated, whole))
    return found.distinct()


def _dealt_candidates(nodes: DataFrame, shape: Shape, segments: range, again: range, crowds: dict, repeated: dict, whole: bool = False) -> DataFrame:
    """Candidates of crowded addresses, which are dealt over tasks.

    In the first round, which knows no components yet, a member goes to one of them, so some pairs don't meet there; the second round takes
    these addresses up again and lets all pairs of different labels meet, whatever
    the labels: members of the most frequent label are dealt over some parts, the others over parts of their own, and there is a task
    for each two parts of others and for each part of others with each of that label.
    """
    later = whole or segments.start > 0
    both = crowds | repeated
    looked_up = [(k, np.array(sorted(found), np.uint64)) for k, found in ((segments, crowds), (again, repeated)) if found]

    def tasks(address: int, node: int, label: int) -> list[int]:
        others, most, frequent = both[address]
        h = xxhash.xxh64_intdigest(node.to_bytes(8, "little", signed=True), address & 0xFFFFFFFF)
        if not later:
            return [h % (others + most - 1)]
        if label == frequent:
            return [others * others + i * most + h % most for i in range(others)]
        own = h % others
        return [min(own, j) * others + max(own, j) for j in range(others)] + [others * others + own * most + j for j in range(most)]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                base.forget()
                ids, labels, words = batch.column(0).to_pylist(), batch.column(1).to_pylist(), _words(batch.column(2))
                out: list[tuple[int, int, int]] = []
                for own, some in looked_up:
                    address = _addresses(words, shape.width, own)
                    for row, column in zip(*np.nonzero(np.isin(address, some))):
                        here = int(address[row, column])
                        out += [(here, t, int(row)) for t in tasks(here, ids[row], labels[row])]
                rows = pa.array([r for _, _, r in out], pa.int64())
                names = [pa.array([a for a, _, _ in out], pa.int64()), pa.array([t for _, t, _ in out], pa.int64())]
                yield pa.RecordBatch.from_arrays([*names, *[batch.column(k).take(rows) for k in range(3)]], ["address", "task", "node", "label", "fp"])

    def match(table: pa.Table) -> pa.Table:
        base.forget()
        ids, labels = (table[c].to_numpy() for c in ("node", "label"))
        words = _words(table["fp"].combine_chunks())
        return _pairs_table(_named(np.zeros(len(ids), np.uint64), np.arange(len(ids)), ids, labels, words, shape, whole))

    entries = nodes.mapInArrow(probe, "address long, task long, node long, label long, fp binary")
    return entries.groupBy("address", "task").applyInArrow(match, "a long, b long")


def confirmed(candidates: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The candidates (a, b) whose shingle sets, of sets(node, shingles), have a Jaccard similarity of at least this."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base.forget()
            a, b = batch.column(2), batch.column(3)
            good = [jaccard(np.frombuffer(a[k].as_buffer(), "<u8"), np.frombuffer(b[k].as_buffer(), "<u8")) >= similarity for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    one = candidates.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a")), "a")
    both = one.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b")), "b")
    return both.select("a", "b", "of_a", "of_b").mapInArrow(check, "a long, b long")


def near_groups(docs: DataFrame, width: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, t, component_id) of documents with equal or similar shingle sets: the smallest id of the group.

    Links are pairs of a Jaccard similarity of at least ``similarity``. ids are integers; t, the text's hash, tells rows
    that share an id apart.
    """

    own = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"))
    shape = Shape.of(own.count(), similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base.forget()
            sets = [shingle_set(t.as_py(), width) for t in batch.column(2)]
            made = [pa.array([_node(h) for h in sets], pa.int64()), pa.array([wide_fingerprint(h, shape.bits) for h in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], ["id", "t", "node", "fp"])

    def spell_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base.forget()
            sets = [shingle_set(t.as_py(), width) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([_node(h) for h in sets], pa.int64()), pa.array([h.tobytes() for h in sets], pa.binary())], ["node", "shingles"])

    def spelled(nodes: DataFrame) -> DataFrame:
        shown = base.written(nodes.select("least.id", "least.t").distinct(), "shown")
        return own.join(shown, ["id", "t"], "left_semi").select("text").mapInArrow(spell_out, "node long, shingles binary").dropDuplicates(["node"])

    marks = base.written(own.mapInArrow(run, "id long, t long, node long, fp binary"), "fingerprints")
    now = base.written(marks.groupBy("node").agg(F.min(F.struct("id", "t")).alias("least"), F.first("fp").alias("fp")).withColumn("label", F.col("node")), "nodes")
    sets = None
    for segments, whole in ((range(first_segments(shape)), False), (range(shape.segments), True)):
        candidates = base.written(near_candidates(now, shape, segments, whole=whole), "candidates")
        named = now.join(candidates.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi")
        new = base.written(spelled(named if sets is None else named.join(sets, "node", "left_anti")), "shingles")
        sets = new if sets is None else sets.unionByName(new)
        found = confirmed(candidates, sets, similarity)
        for c in "ab":
            found = found.join(now.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}")), c)
        roots = base.connected_components(found.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")))
        joined = now.join(roots.withColumnRenamed("node", "label"), "label", "left")
        old, now = now, base.written(joined.select("node", "least", "fp", F.coalesce("root", "label").alias("label")), "labels")
        base.discard(old, candidates)
    smallest = now.groupBy("label").agg(F.min("least.id").alias("component_id"))
    return marks.select("id", "t", "node").join(now.join(smallest, "label").select("node", "component_id"), "node").select("id", "t", "component_id")


def keep_one(docs: DataFrame, width: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows whose group has a smaller id; rows with a null id stay."""
    gone = near_groups(docs, width, similarity, id_col, text_col).where("id > component_id").select(F.struct("id", "t").alias("_gone"))
    same = (F.col(id_col) == F.col("_gone.id")) & (F.xxhash64(text_col) == F.col("_gone.t"))
    return docs.join(gone.hint("shuffle_hash"), same, "left_anti")


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = components(docs, width=3)
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
