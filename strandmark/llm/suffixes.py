"""Operator 9: dedup of repeated passages by sorting suffixes, on bytes.

A byte goes if a ``LENGTH``-byte string that covers it also starts in a document with a smaller id. Suffixes are told
apart by their first LENGTH bytes, so a suffix array over all positions would do; at one row a byte that is some 60
times the input, so suffixes that no other document can hold are left out first, and neighbours travel together:

1. Anchors. Each LENGTH-byte window has an anchor, the KGRAM-byte string in it of least hash (the leftmost). It depends
   on the window's bytes alone, so equal windows have equal anchors in equal places. Neighbouring windows mostly share
   theirs: such windows are a run, some 6 runs for 100 bytes.
2. Filter. Each block of documents sends the hashes of its distinct anchors, some 2 bytes each; a bucket answers which of
   them more than one document may hold. Hashes decide nothing else: where two anchors collide, more is sorted.
3. Sort. Of the anchors that are left each block sends its distinct runs (equal ones are found by hash and compared
   byte for byte), as the suffixes of the run in one string. Sampled splitters range-partition them by their leading bytes
   from the anchor on, so equal suffixes never part. Each bucket sorts its strings by three-way multikey quicksort, whose
   characters are 8 bytes, and keeps how many characters neighbours share; equal runs are one string, and only where
   several different runs have an anchor their windows are sorted the same way, one by one. A window goes if an equal one
   has a smaller id. A bucket's first and last strings are compared with the splitters across its boundaries.
4. The answers, a bit a window, meet the texts again.

Every byte that goes was compared. Hot keys: equal runs of a block are one string; windows of an anchor with more than
``FEW`` different runs in a block, or in more than ``MANY`` blocks, travel one by one, equal ones of a block once, keyed by
all of their own bytes. So nothing that a third of all documents share meets in one task.

Blocks are the documents of one hash of the id, so many that one has about ``BLOCK_BYTES``; the text is exchanged once,
the three passes over it reuse that.

Edge cases: null and empty texts and those shorter than LENGTH are never cut; rows sharing an id never cut each other;
rows with a null id stay as they are and cut nothing; overlapping repeats count once; other columns are carried, those
named like a result are replaced; an empty table gives an empty table. Cutting bytes may leave broken characters:
``kept`` is binary.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import base

LENGTH, KGRAM = 50, 20
SPAN = LENGTH - KGRAM + 1
FEW, MANY = 16, 512
BLOCK_BYTES = 2 << 20
#: Bytes of text for which there is a bucket of hashes; ranges of strings, which are longer, are RANGES times as many.
BUCKET_BYTES, RANGES = 16 << 20, 4
#: So many documents, and strings of each, from which the splitters are taken.
SAMPLE_DOCS, SAMPLE_STRINGS = 4096, 8
NOTHING, SORT, SINGLY = 0, 1, 2
#: Of an anchor's hash within its bucket: a bucket has some half a million, so few collide.
KEY_MASK = np.uint64((1 << 27) - 1)
_CHUNK = 1 << 17
_POS = np.uint64((1 << 20) - 1)
#: 8-byte words that cover an anchor, a window and the longest run.
_GRAM_WORDS = (*range(0, KGRAM - 7, 8), KGRAM - 8)
_FACTORS = [np.uint64(0xC2B2AE3D27D4EB4F + 2 * k * 0x9E3779B97F4A7C15 & (1 << 64) - 1) for k in range(len(_GRAM_WORDS))]
_WORDS = (*range(0, LENGTH - 7, 8), LENGTH - 8)
RUN_BYTES = 8 * -(-(SPAN - 1 + LENGTH) // 8)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    step = 1
    while 2 * step <= width:
        h = np.minimum(h[:-step], h[step:])
        step *= 2
    return np.minimum(h[: len(h) - (width - step)], h[width - step :]) if step < width else h


def _heads(ordered: np.ndarray) -> np.ndarray:
    """Where each group of equal neighbours begins."""
    return np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)


def _places(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    ends = np.cumsum(count)
    return np.repeat(first - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)


def _shut(*parts: np.ndarray) -> bytes:
    """Arrays in one compressed string."""
    raw = [np.ascontiguousarray(p).tobytes() for p in parts]
    return zstandard.ZstdCompressor(level=3).compress(struct.pack(f"<{len(raw)}Q", *map(len, raw)) + b"".join(raw))


def _opened(data: bytes, *types: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes = struct.unpack_from(f"<{len(types)}Q", raw)
    out, at = [], 8 * len(types)
    for n, t in zip(sizes, types):
        out.append(np.frombuffer(raw, t, n // np.dtype(t).itemsize, at))
        at += n
    return out


def _differences(ordered: np.ndarray) -> np.ndarray:
    """Ascending uint32 as byte planes of their differences, which compress well."""
    return np.diff(ordered, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T


class Block:
    """The documents of a block in ascending order of id, and their runs of windows."""

    def __init__(self, ids: np.ndarray, texts: list[bytes], buckets: int, hash_bits: int = 64) -> None:
        self.ids, self.hash_mask = ids, np.uint64((1 << hash_bits) - 1)
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.data = b"".join(texts) + b"\0" * (LENGTH + RUN_BYTES)
        n = int(self.sizes.sum())
        view = np.ndarray((n + LENGTH + RUN_BYTES - 8,), "<u8", self.data, strides=(1,))
        self.view, self.bytes = view, np.frombuffer(self.data, np.uint8)
        anchors = np.empty(n + 1, np.int32)
        anchors[n] = -1
        for a in range(0, n, _CHUNK):
            b = min(n, a + _CHUNK)
            end = b + SPAN - 1
            h = view[a:end] * _FACTORS[0]
            for step, factor in zip(_GRAM_WORDS[1:], _FACTORS[1:]):
                h += view[a + step : end + step] * factor
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            h &= ~_POS
            h |= np.arange(len(h), dtype=np.uint64)
            anchors[a:b] = (_least(h, SPAN) & _POS).astype(np.int32) + a
        short = np.minimum(self.sizes, LENGTH - 1)
        anchors[_places(self.ends - short, short)] = -1  # no window starts there
        bounds = np.concatenate(([0], np.flatnonzero(anchors[1:] != anchors[:-1]) + 1)) if n else np.zeros(0, np.int64)
        runs = np.flatnonzero(anchors[bounds] >= 0)
        self.first, self.count = bounds[runs], np.diff(np.append(bounds, n + 1))[runs]
        self.anchor = anchors[self.first].astype(np.int64)
        self.owner = np.searchsorted(self.ends, self.first, side="right")
        h = np.full(len(self.anchor), 0xA24BAED4963EE407, np.uint64)
        for step in _GRAM_WORDS:
            h = _mix(h * np.uint64(0xD6E8FEB86659FD93) ^ view[self.anchor + step])
        h &= self.hash_mask
        key = ((h >> np.uint64(40)) % np.uint64(buckets)) << np.uint64(32) | h & KEY_MASK
        self._group(key)

    def hashed(self, at: np.ndarray) -> np.ndarray:
        """Of the windows that start there."""
        h = np.full(len(at), 0x27D4EB2F165667C5, np.uint64)
        for o in _WORDS:
            h = _mix(h * np.uint64(0x9FB21C651E98DF25) ^ self.view[at + o])
        return h & self.hash_mask

    def _tails(self, at: np.ndarray, count: np.ndarray) -> list[np.ndarray]:
        """What the last window of a run has beyond the first one, in words from its end."""
        ends = at + count - 1 + LENGTH
        return [self.view[ends - step] for step in range(8, SPAN + 7, 8)]

    def _group(self, key: np.ndarray) -> None:
        """``rep``: a run's equal of least place, so of least id; ``later``: whether that one's id is smaller; ``slot``: the
        run's anchor among the distinct ones, ``keys``; ``many``, ``wild``: anchors of several documents, of many runs."""
        n = len(key)
        shape = (self.anchor - self.first) * 64 + self.count
        h = self.hashed(self.first) + shape.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)
        for word in self._tails(self.first, self.count):
            h = _mix(h * np.uint64(0xD6E8FEB86659FD93) ^ word)
        h &= self.hash_mask
        owners = self.ids[self.owner]
        same = _mix(key ^ h * np.uint64(0xA24BAED4963EE407)) & self.hash_mask
        order = np.argsort(same, kind="stable")
        starts = _heads(same[order])
        rep = np.empty(n, np.int64)
        rep[order] = np.repeat(order[starts], np.diff(np.append(starts, n)))
        # equal hashes prove nothing: runs that differ from their representative stand for themselves
        differs = shape != shape[rep]
        for o in _WORDS:
            differs |= self.view[self.first + o] != self.view[self.first[rep] + o]
        for a, b in zip(self._tails(self.first, self.count), self._tails(self.first[rep], self.count[rep])):
            differs |= a != b
        rep = np.where(differs, np.arange(n), rep)
        self.rep, self.later = rep, owners > owners[rep]
        o = np.argsort(key, kind="stable")
        heads = _heads(key[o])
        self.keys = key[o][heads]
        self.slot = np.empty(n, np.int64)
        self.slot[o] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, n)))
        own = owners[o]
        self.many = np.minimum.reduceat(own, heads) != np.maximum.reduceat(own, heads) if n else np.zeros(0, bool)
        self.wild = np.bincount(self.slot[rep == np.arange(n)], minlength=len(heads)) > FEW

    def messages(self) -> tuple[np.ndarray, np.ndarray]:
        """Buckets that get keys, and the bounds of their parts of ``keys``."""
        bucket = self.keys >> np.uint64(32)
        heads = _heads(bucket)
        return bucket[heads].astype(np.int64), np.append(heads, len(bucket))

    def singles(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows that travel one by one: their places, each one's distinct string, and the first place of each string."""
        runs = np.flatnonzero((states == SINGLY) & ~self.later)
        places = _places(self.first[runs], self.count[runs])
        _, rep, of = np.unique(self.hashed(places), return_index=True, return_inverse=True)
        raw = np.lib.stride_tricks.sliding_window_view(self.bytes, LENGTH)
        if not (raw[places] == raw[places[rep[of]]]).all():  # two strings of one hash
            return places, np.arange(len(places)), places
        return places, of, places[rep]

    def strings(self, at: np.ndarray, length: int) -> np.ndarray:
        return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(self.bytes, length)[at]).view(f"S{length}").ravel()


class Parcels:
    """What a block sends to be sorted, by bucket: the same whenever it's made from the block and its states."""

    def __init__(self, block: Block, states: np.ndarray, splitters: np.ndarray) -> None:
        self.runs = np.flatnonzero((states == SORT) & (block.rep == np.arange(len(states))))
        self.places, self.of, self.firsts = block.singles(states)
        # runs lie where their anchor does, whatever follows it
        by_anchor = np.searchsorted(splitters.astype(f"S{KGRAM}"), block.strings(block.anchor[self.runs], KGRAM), side="right")
        by_window = np.searchsorted(splitters, block.strings(self.firsts, LENGTH), side="right")
        n = len(splitters) + 1
        self.run_order, self.one_order = np.argsort(by_anchor, kind="stable"), np.argsort(by_window, kind="stable")
        self.run_at = np.searchsorted(by_anchor[self.run_order], np.arange(n + 1))
        self.one_at = np.searchsorted(by_window[self.one_order], np.arange(n + 1))
        self.buckets = np.flatnonzero(np.diff(self.run_at) + np.diff(self.one_at)).tolist()

    def of_bucket(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(runs, numbers of single strings) in the order in which they're sent."""
        return self.runs[self.run_order[self.run_at[b] : self.run_at[b + 1]]], self.one_order[self.one_at[b] : self.one_at[b + 1]]


def _block(ids: pa.Array, texts: pa.Array, buckets: int, hash_bits: int) -> tuple[Block, np.ndarray]:
    """The block, and the order in which it has the rows."""
    values = ids.to_numpy(zero_copy_only=False)
    order = np.argsort(values, kind="stable")
    raw = [t or b"" for t in texts.to_pylist()]
    return Block(values[order], [raw[k] for k in order], buckets, hash_bits), order


def multikey(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Three-way multikey quicksort of the rows of ``words``: their order, and how many words each shares with the row
    before it (the first: -1).

    All open parts advance together: the rows of a part agree in their first words; they're split into those whose next
    word is less than, equal to or greater than the part's pivot, and those with an equal one go on to the word after it."""
    n, width = words.shape
    order, shared = np.arange(n), np.full(n, width)
    shared[:1] = -1
    start, size, depth = (np.array([x]) if n > 1 and width else np.zeros(0, np.int64) for x in (0, n, 0))
    while len(start):
        at = _places(start, size)
        part = np.repeat(np.arange(len(start)), size)
        rows = order[at]
        word = words[rows, depth[part]]
        first = np.cumsum(size) - size
        ends = np.sort([word[first], word[first + size // 2], word[first + size - 1]], axis=0)
        pivot = ends[1][part]
        kind = (word >= pivot).astype(np.int8) + (word > pivot)
        place, offset, parts = np.empty(len(at), np.int64), start.copy(), []
        for k in range(3):
            own = kind == k
            rank = np.cumsum(own)
            before = np.append(0, rank)[first]
            many = rank[first + size - 1] - before
            here = np.flatnonzero(own)
            place[here] = (offset - before)[part[here]] + rank[here] - 1
            parts.append((offset.copy(), many, depth + (k == 1)))
            new = (many > 0) & (offset > start)
            shared[offset[new]] = depth[new]
            offset += many
        order[place] = rows
        start, size, depth = (np.concatenate(x) for x in zip(*parts))
        open_ = (size > 1) & (depth < width)
        start, size, depth = start[open_], size[open_], depth[open_]
    return order, shared


def _words(raw: np.ndarray, at: np.ndarray, offsets) -> np.ndarray:
    """The 8-byte words at these offsets from each place, as numbers in the order of their bytes."""
    view = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    return np.stack([view[at + o] for o in offsets], axis=1).byteswap() if len(at) else np.zeros((0, len(offsets)), np.uint64)


def _repeated(strings: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether an equal string (row of words) has a smaller id."""
    order, shared = multikey(strings)
    heads = np.flatnonzero(shared < strings.shape[1])
    least = np.minimum.reduceat(ids[order], heads) if len(heads) else ids[:0]
    out = np.zeros(len(ids), bool)
    out[order] = ids[order] > np.repeat(least, np.diff(np.append(heads, len(order))))
    return out


def sort_runs(raw: np.ndarray, starts: np.ndarray, count: np.ndarray, lead: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Of each window of each run, one run after another: whether an equal window has a smaller id. And the first and last
    anchor in order.

    raw: the runs' bytes and RUN_BYTES more; lead: the anchor's offset in the run."""
    n = len(starts)
    gone = np.zeros(int(count.sum()), bool)
    if not n:
        return gone, []
    # the anchor first, then the run's shape, then all of its bytes (those behind its end are blanked)
    grams = len(_GRAM_WORDS)
    width = grams + 1 + RUN_BYTES // 8
    keys = np.empty((n, width), np.uint64)
    view = np.lib.stride_tricks.sliding_window_view(raw, RUN_BYTES)
    for a in range(0, n, 1 << 14):
        part = slice(a, a + (1 << 14))
        keys[part, :grams] = _words(raw, starts[part] + lead[part], _GRAM_WORDS)
        keys[part, grams] = lead[part] * 64 + count[part]
        body = view[starts[part]]
        body[np.arange(RUN_BYTES) >= (count[part] - 1 + LENGTH)[:, None]] = 0
        keys[part, grams + 1 :] = body.view("<u8").byteswap()
    order, shared = multikey(keys)
    del keys
    heads = np.flatnonzero(shared < width)  # distinct runs
    many = np.diff(np.append(heads, n))
    least = np.minimum.reduceat(ids[order], heads)
    run_of = np.empty(n, np.int64)
    run_of[order] = np.repeat(np.arange(len(heads)), many)
    ends = np.cumsum(count)
    later = np.flatnonzero(ids > least[run_of])
    gone[_places((ends - count)[later], count[later])] = True
    # anchors that several different runs have: their windows one by one, those of each distinct run once
    new = np.flatnonzero(shared[heads] < grams)
    kinds = np.diff(np.append(new, len(heads)))
    open_ = np.flatnonzero(np.repeat(kinds > 1, kinds))
    if len(open_):
        rep = order[heads[open_]]
        at = _places(starts[rep], count[rep])
        hit = _repeated(_words(raw, at, _WORDS), np.repeat(least[open_], count[rep]))
        first = np.zeros(len(heads), np.int64)
        first[open_] = np.cumsum(count[rep]) - count[rep]
        is_open = np.zeros(len(heads), bool)
        is_open[open_] = True
        rows = np.flatnonzero(is_open[run_of])
        gone[_places((ends - count)[rows], count[rows])] |= hit[_places(first[run_of[rows]], count[rows])]
    return gone, [raw[a : a + KGRAM].tobytes() for a in (starts + lead)[order[[0, -1]]]]


def across(bounds: np.ndarray, bucket: int, ends: list[bytes]) -> None:
    """Compares a bucket's first and last strings with the splitters to the next buckets: none may lie across a boundary,
    where an equal one would not be found."""
    for s in ends:
        if int(np.searchsorted(bounds.astype(f"S{KGRAM}"), np.array(s, f"S{KGRAM}"), side="right")) != bucket:
            raise ValueError("a suffix lies outside its bucket")


def _cut(gone: np.ndarray) -> np.ndarray:
    """Bytes that a repeated window covers; gone: by place, whether the window that starts there is one."""
    c = np.concatenate((np.zeros(LENGTH, np.int32), np.cumsum(gone, dtype=np.int32)))
    return c[LENGTH:] > c[:-LENGTH]


def _states(block: Block, answers: dict[int, bytes]) -> np.ndarray:
    """NOTHING, SORT or SINGLY of each run."""
    found = np.zeros(len(block.keys), np.uint8)
    buckets, at = block.messages()
    for b, i, j in zip(buckets.tolist(), at, at[1:]):
        (found[i:j],) = _opened(answers[b], "u1")
    return found[block.slot]


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64) -> DataFrame:
    """docs and ``n_bytes, n_removed, n_spans, kept`` (binary); text_col leaves. ids are integers; rows with a null id are
    uncut and cut nothing. hash_bits: fewer make hashes collide, which costs time and changes nothing."""
    cut = _repeats(docs, id_col, text_col, False, hash_bits)
    raw, none = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8"), F.lit(0).cast("long")
    added = {"n_bytes": F.octet_length(raw).cast("long"), "n_removed": none, "n_spans": none, "kept": raw}
    whole = docs.where(F.col(id_col).isNull()).select(*[added[c].alias(c) if c in added else F.col(f"`{c}`") for c in cut.columns])
    return cut.unionByName(whole)


def splitters(rows: DataFrame, documents: int, buckets: int) -> np.ndarray:
    """At most buckets - 1 strings of LENGTH bytes, ascending, of rows(raw): quantiles of strings that begin with an
    anchor, of some SAMPLE_DOCS documents."""
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for raw in batch.column(0).to_pylist():
                block = Block(np.zeros(1, np.int64), [raw or b""], 1)
                at = block.anchor[np.linspace(0, len(block.anchor) - 1, SAMPLE_STRINGS).astype(int)] if len(block.anchor) else []
                found += [block.data[k : k + LENGTH] for k in at]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["s"])

    sample = rows.select("raw").sample(min(1.0, SAMPLE_DOCS / max(1, documents)), 1).mapInArrow(pick, "s binary").collect()
    ordered = sorted(bytes(r.s) for r in sample)
    chosen = sorted({ordered[len(ordered) * k // buckets] for k in range(1, buckets)}) if ordered else []
    return np.array(chosen, f"S{LENGTH}")


def _repeats(docs: DataFrame, id_col: str, text_col: str, as_text: bool, hash_bits: int = 64) -> DataFrame:
    """docs (rows with an id) and ``n_bytes, n_removed, n_spans, kept``; text_col leaves. ids are integers.

    kept is binary; as text, characters that a cut went through go as well."""
    spark = docs.sparkSession
    own_rows = docs.where(F.col(id_col).isNotNull())
    size = own_rows.agg(F.count("*").alias("n"), F.sum(F.octet_length(text_col)).alias("b")).first()
    blocks, buckets = (max(base.partitions_for(spark), -(-(size.b or 0) // n)) for n in (BLOCK_BYTES, BUCKET_BYTES))
    ranges = RANGES * buckets
    results = ["n_bytes", "n_removed", "n_spans", "kept"]
    rest = [c for c in docs.columns if c not in (text_col, *results)]
    carried = [f"_{k}" for k in range(len(rest))]
    rows = own_rows.select(F.pmod(F.xxhash64(id_col), F.lit(blocks)).cast("int").alias("h"), F.col(id_col).cast("long").alias("id"), F.encode(F.col(text_col), "UTF-8").alias("raw"), *[F.col(f"`{c}`").alias(x) for c, x in zip(rest, carried)])
    types = {c: docs.schema[c].dataType.simpleString() for c in rest}
    bounds = splitters(rows.select("raw"), size.n, ranges)

    def opened(own: pa.Table) -> tuple[Block, np.ndarray, int]:
        return *_block(own["id"].combine_chunks(), own["raw"].combine_chunks(), buckets, hash_bits), own["h"][0].as_py()

    def send(own: pa.Table) -> pa.Table:
        base.forget()
        block, _, h = opened(own)
        numbers, at = block.messages()
        low = block.keys.astype(np.uint32)
        out = [_shut(_differences(low[i:j]), np.packbits(block.many[i:j]), np.packbits(block.wild[i:j])) for i, j in zip(at, at[1:])]
        return pa.table({"bucket": pa.array(numbers, pa.int32()), "h": pa.array([h] * len(out), pa.int32()), "rows": pa.array(out, pa.binary())})

    def settle(table: pa.Table) -> pa.Table:
        base.forget()
        keys, many, wild = [], [], []
        for raw in table["rows"].to_pylist():
            k, m, w = _opened(raw, "u1", "u1", "u1")
            k = np.ascontiguousarray(k.reshape(4, -1).T).view("<u4").ravel()
            keys.append(np.cumsum(k, dtype=np.uint32))
            many.append(np.unpackbits(m, count=len(k)))
            wild.append(np.unpackbits(w, count=len(k)))
        sizes = list(map(len, keys))
        keys, many, wild = np.concatenate(keys), np.concatenate(many), np.concatenate(wild)
        order = np.argsort(keys)
        heads = _heads(keys[order])
        held = np.diff(np.append(heads, len(keys)))
        shared = (held > 1) | np.logical_or.reduceat(many[order], heads)
        loose = (held > MANY) | np.logical_or.reduceat(wild[order], heads)
        found = np.empty(len(keys), np.uint8)
        found[order] = np.repeat(np.where(shared, np.where(loose, SINGLY, SORT), NOTHING).astype(np.uint8), held)
        return pa.table({"h": table["h"], "bucket": table["bucket"], "answer": pa.array(list(map(_shut, np.split(found, np.cumsum(sizes)[:-1]))), pa.binary())})

    names = {"bucket": pa.int32(), "h": pa.int32(), "states": pa.bool_(), "rows": pa.binary()}

    def suffixes(own: pa.Table, answers: pa.Table) -> pa.Table:
        base.forget()
        if not own.num_rows:
            return pa.table({c: pa.array([], t) for c, t in names.items()})
        block, _, h = opened(own)
        states = _states(block, dict(zip(answers["bucket"].to_pylist(), answers["answer"].to_pylist())))
        parcels = Parcels(block, states, bounds)
        out = []
        for b in parcels.buckets:
            runs, ones = parcels.of_bucket(b)
            length = block.count[runs] - 1 + LENGTH
            first = parcels.firsts[ones]
            holders = block.ids[np.searchsorted(block.ends, first, side="right")]
            out.append(_shut(block.bytes[_places(block.first[runs], length)], block.count[runs].astype("u1"), (block.anchor[runs] - block.first[runs]).astype("u1"), block.ids[block.owner[runs]].astype("<i8"), block.bytes[_places(first, np.full(len(first), LENGTH))], holders.astype("<i8")))
        # the states come along to the last pass
        numbers, kinds = [*parcels.buckets, h % buckets], [False] * len(out) + [True]
        out.append(_shut(states))
        return pa.table({c: pa.array(v, t) for (c, t), v in zip(names.items(), (numbers, [h] * len(out), kinds, out))})

    def compare(table: pa.Table) -> pa.Table:
        base.forget()
        kinds = table["states"].to_pylist()
        packed = table["rows"].to_pylist()
        got = [_opened(x, "u1", "u1", "u1", "<i8", "u1", "<i8") for x, s in zip(packed, kinds) if not s]
        answers = iter(())
        if got:
            raw, count, lead, ids, ones, holders = (np.concatenate([*x, np.zeros(RUN_BYTES, np.uint8)]) if k in (0, 4) else np.concatenate(x) for k, x in enumerate(zip(*got)))
            count, lead = count.astype(np.int64), lead.astype(np.int64)
            ends = np.cumsum(count - 1 + LENGTH)
            gone, outer = sort_runs(raw, ends - (count - 1 + LENGTH), count, lead, ids)
            across(bounds, table["bucket"][0].as_py(), outer)
            hit = _repeated(_words(ones, LENGTH * np.arange(len(holders)), _WORDS), holders)
            windows = np.cumsum([int(x[1].sum(dtype=np.int64)) for x in got])[:-1]
            answers = iter([_shut(np.packbits(g), np.packbits(o)) for g, o in zip(np.split(gone, windows), np.split(hit, np.cumsum([len(x[5]) for x in got])[:-1]))])
        return pa.table({"h": table["h"], "bucket": table["bucket"], "states": table["states"], "answer": pa.array([x if s else next(answers) for x, s in zip(packed, kinds)], pa.binary())})

    kept_type = pa.string() if as_text else pa.binary()

    def finish(own: pa.Table, answers: pa.Table) -> pa.Table:
        base.forget()
        if not own.num_rows:
            return pa.table([pa.array([], own.schema.field(x).type) for x in carried] + [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), kept_type)], names=[*rest, *results])
        block, order, _ = opened(own)
        by_bucket = {(s, b): a for s, b, a in zip(answers["states"].to_pylist(), answers["bucket"].to_pylist(), answers["answer"].to_pylist())}
        (states,) = next(_opened(a, "u1") for (s, _), a in by_bucket.items() if s)
        parcels = Parcels(block, states, bounds)
        n = len(states)
        gone = np.zeros(int(block.sizes.sum()), bool)
        hit = np.zeros(len(parcels.firsts), bool)
        for b in parcels.buckets:
            runs, ones = parcels.of_bucket(b)
            bits, one_bits = _opened(by_bucket[False, b], "u1", "u1")
            count = block.count[runs]
            gone[_places(block.first[runs], count)] = np.unpackbits(bits, count=int(count.sum()))
            hit[ones] = np.unpackbits(one_bits, count=len(ones))
        # other runs take over what their representative got; what a smaller id of the block holds goes anyhow
        more = np.flatnonzero((states == SORT) & (block.rep != np.arange(n)))
        gone[_places(block.first[more], block.count[more])] = gone[_places(block.first[block.rep[more]], block.count[more])]
        if len(parcels.places):
            holder = block.ids[np.searchsorted(block.ends, parcels.places, side="right")]
            least = np.full(len(parcels.firsts), np.iinfo(np.int64).max)
            np.minimum.at(least, parcels.of, holder)
            gone[parcels.places] |= hit[parcels.of] | (holder > least[parcels.of])
        later = np.flatnonzero(block.later & (states != NOTHING))
        gone[_places(block.first[later], block.count[later])] = True
        covered = _cut(gone)
        removed, spans, kept = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64), []
        for k, (a, b) in enumerate(zip(block.starts.tolist(), block.ends.tolist())):
            c = covered[a:b]
            removed[k] = m = int(np.count_nonzero(c))
            if m:
                spans[k] = int(c[0]) + int(np.count_nonzero(c[1:] & ~c[:-1]))
                kept.append(block.bytes[a:b][~c].tobytes())
            else:
                kept.append(block.data[a:b])
        back = pa.array(order)
        return pa.table([*(own[x].take(back) for x in carried), pa.array(block.sizes), pa.array(removed), pa.array(spans), pa.array([x.decode(errors="ignore") for x in kept] if as_text else kept, kept_type)], names=[*rest, *results])

    sent = rows.select("h", "id", "raw", *carried).groupBy("h").applyInArrow(send, "bucket int, h int, rows binary")
    settled = sent.groupBy("bucket").applyInArrow(settle, "h int, bucket int, answer binary")
    left = rows.groupBy("h").cogroup(settled.groupBy("h")).applyInArrow(suffixes, "bucket int, h int, states boolean, rows binary")
    compared = left.groupBy("bucket").applyInArrow(compare, "h int, bucket int, states boolean, answer binary")
    schema = ", ".join([f"`{c}` {t}" for c, t in types.items()] + [f"n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}"])
    return rows.groupBy("h").cogroup(compared.groupBy("h")).applyInArrow(finish, schema)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with repeated passages cut from text_col; the same columns. Rows with a null id stay as they are."""
    cut = _repeats(docs, id_col, text_col, as_text=True).withColumnRenamed("kept", text_col)
    return cut.select(docs.columns).unionByName(docs.where(F.col(id_col).isNull()))


def op9_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    cut = repeats(docs)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: All windows of all texts as hexadecimal strings, and the first document of each: brute force, for tables of megabytes.
SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
chunks AS (SELECT doc_id, place, substr(h, 2 * place + 1, 2 * (500 + 49)) AS h, least(500, n - 49 - place) AS k FROM (SELECT doc_id, h, n, unnest(range(0, greatest(n - 49, 0), 500)) AS place FROM d)),
windows AS (SELECT doc_id, place + j AS p, substr(h, 2 * j + 1, 100) AS s FROM (SELECT doc_id, place, h, unnest(range(0, k)) AS j FROM chunks)),
firsts AS (SELECT s, min(doc_id) AS least FROM windows GROUP BY s HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT w.doc_id, w.p, lag(w.p) OVER (PARTITION BY w.doc_id ORDER BY w.p) AS before FROM windows w JOIN firsts f ON f.s = w.s AND f.least < w.doc_id),
runs AS (SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS run FROM hits),
spans AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS b FROM runs GROUP BY ALL),
pieces AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans UNION ALL SELECT doc_id, max(b), NULL FROM spans GROUP BY doc_id),
kept AS (SELECT p.doc_id, string_agg(substr(d.h, 2 * p.a + 1, 2 * (coalesce(p.b, d.n) - p.a)), '' ORDER BY p.a) AS h FROM pieces p JOIN d USING (doc_id) GROUP BY p.doc_id),
cut AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS removed, count(*) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, coalesce(c.removed, 0) AS n_removed, coalesce(c.spans, 0) AS n_spans, sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256 FROM d LEFT JOIN cut c USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""
