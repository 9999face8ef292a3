"""Operator 12: secrets in texts. Three patterns give base spans; a conditional random field tags tokens and adds spans.

A token is a run of letters, digits, ``_ + / -`` and bytes beyond ASCII, or any other single byte that isn't blank. Its features
are those of its shape (kinds of characters, length, how many different ones, changes between letters and digits, the
first four where these hold no digit), its word if short, the neighbouring words and shapes (three before, one after), and the file's: shares of
punctuation and of tokens with digits, lengths of lines, the text's size. Tags are secret begin, inside and outside;
the best path is found by Viterbi (``crf``). Nobody has labelled secrets here, so the base spans' values are what the field learns from:
``fit`` takes windows of a bounded sample of texts, half of them with base spans if there are so many. Each window is
shown a second time without the neighbours, so that a value is known by its shape as well, under keys that no pattern lists.

Spans are (kind, start, end) in code points, end exclusive, the whole match of a pattern: kinds ``assign``, ``access``, ``hex``, and ``model`` for
what the field adds: runs of begin and inside that no base span contains. Base spans are never changed.

All texts are counted and tagged whole. The sample decides what is learned, nothing else; it's taken by a hash of the text, so equal texts count
once and a lost task gives the same again. Texts don't leave their tasks: the driver gets feature numbers of windows.

Edge cases: null and empty texts have no spans; rows that repeat or share an id are tagged each by its own text; ids are
never used and may be null; without any base span in the table nothing is learned and only base spans (none) are given; a text of one
giant token is one token; columns named as the new one are replaced (the case of names doesn't count), others stay; an empty table gives
an empty table.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from . import base, crf, tokens
from .infill import view
from .succinct import Bits, starts_of_points

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: (kind, pattern, group that holds the value, least length of the value), in the order of kinds.
BASE = [("assign", re.compile(ASSIGN, re.I | re.A), 2, 8), ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile(r"[0-9a-f]+"), 0, 32)]
ADDED = "model"
#: Texts with base spans, and others, that are learned from at most; windows of a text, and tokens in a window.
SAMPLE_TEXTS = 1_200
WINDOWS, WINDOW = 2, 24
#: One window in so many is shown a second time, without neighbours.
BARE = 1
#: Words are hashed into so many numbers, first characters into LEADS; words of more bytes count by their shape only.
WORDS, LEADS, WORD_BYTES = 1 << 14, 1 << 12, 16
#: Bits of a shape: what characters a token has, and whether it has some that a number in hexadecimal (of small, of capital letters) hasn't.
KINDS = 9
LENGTHS = np.array([2, 4, 8, 12, 16, 20, 24, 32, 48, 80])
SPREADS, TURNS = 8, 6
_BLOCKS = [1, 1, 1 << KINDS, len(LENGTHS) + 1, (1 << KINDS) * (len(LENGTHS) + 1), (len(LENGTHS) + 1) * SPREADS, (1 << KINDS) * TURNS, LEADS, WORDS]
#: Features of a token as itself, and its two as each neighbour.
OWN, ROLES = 8, ("p1", "p2", "p3", "n1")
_NEAR = [WORDS, (1 << KINDS) * 5 + 256]
FILE_KINDS, FILE_STEPS = 4, 8
#: Where each kind of feature begins; number 0 stands for none.
_AT = np.cumsum([0, *_BLOCKS, *_NEAR * len(ROLES), FILE_KINDS * FILE_STEPS])
SIZE, FILES = int(_AT[-1]), int(_AT[-2])
SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())]))

_BLANK, _WORD, _MARK = 0, 1, 2
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _BLANK
_CLASS[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_+/-", *range(128, 256)]] = _WORD


def base_spans(text: str) -> list[tuple[str, int, int, int, int]]:
    """(kind, start, end, start and end of the value), by start, then kind."""
    found = []
    for order, (kind, pattern, group, least) in enumerate(BASE):
        found += [(m.start(), order, kind, m.end(), *m.span(group)) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return [(kind, a, b, c, d) for a, _, kind, b, c, d in sorted(found)]


def may_hold(texts: pa.Array) -> np.ndarray:
    """Whether a text can have a base span."""
    some = pc.match_substring_regex(texts, ASSIGN, ignore_case=True)
    some = pc.or_(some, pc.match_substring(texts, "AKIA"))
    return pc.or_(some, pc.match_substring_regex(texts, "[0-9a-f]{32}")).to_numpy(zero_copy_only=False)


def _bits() -> np.ndarray:
    """By byte: the bits it gives to a token's shape."""
    out = np.zeros(256, np.uint16)
    for bit, some in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"_", b"-", b"+/", range(128, 256))):
        out[list(some)] |= 1 << bit
    for bit, some in ((7, b"0123456789abcdef"), (8, b"0123456789ABCDEF")):
        out[[x for x in range(256) if x not in some]] |= 1 << bit
    return out


_SHAPE = _bits()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mixed(head: np.ndarray) -> np.ndarray:
    """A hash of each row of 16 bytes."""
    two = np.ascontiguousarray(head).view("<u8")
    h = two[:, 0] * np.uint64(0x9E3779B97F4A7C15) ^ (two[:, 1] + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)


def described(names: pa.Array) -> np.ndarray:
    """Numbers of the features of distinct tokens: OWN as itself, then two for each of ROLES; the last row is what lies beyond a
    text's ends."""
    out = np.zeros((len(names) + 1, OWN + 2 * len(ROLES)), np.int32)
    near = _AT[1 + len(_BLOCKS) :: 2][: len(ROLES)]
    beyond = (1 << KINDS) * 5 + 255
    out[-1, OWN + 1 :: 2] = near + beyond
    if not len(names):
        return out
    data, at, _ = view(names)
    first, size = at[:-1], np.diff(at)
    shape = np.bitwise_or.reduceat(_SHAPE[data], first).astype(np.int64)
    length = np.searchsorted(LENGTHS, size, side="right")
    distinct = np.bitwise_count(np.bitwise_or.reduceat(np.uint64(1) << (data & 63).astype(np.uint64), first))
    spread = np.minimum(SPREADS - 1, distinct // 4)
    digit, letter = _SHAPE[data] & 4 > 0, _SHAPE[data] & 3 > 0
    turn = np.zeros(len(data), np.int64)
    turn[1:] = digit[1:] & letter[:-1] | letter[1:] & digit[:-1]
    turn[first] = 0
    turns = np.minimum(TURNS - 1, 10 * np.add.reduceat(turn, first) // size)
    place = np.arange(WORD_BYTES)
    head = np.where(place < size[:, None], data[np.minimum(first[:, None] + place, len(data) - 1)], 0).astype(np.uint8)
    lead = head.copy()
    lead[:, 4:] = 0
    led = (size >= 12) & ~(_SHAPE[head[:, :4]] & 4).any(1) & (shape & 6 > 0)
    worded = (size <= WORD_BYTES) & (shape & 4 == 0)
    word = _mixed(_LOWER[head]).astype(np.int64) % WORDS
    mark = _CLASS[data[first]] == _MARK
    blocks = [0, shape, length, shape * (len(LENGTHS) + 1) + length, length * SPREADS + spread, shape * TURNS + turns, np.where(led, _mixed(lead).astype(np.int64) % LEADS, -1), np.where(worded, word, -1)]
    for k, own in enumerate(blocks):
        out[:-1, k] = np.where(own >= 0, _AT[1 + k] + own, 0)
    about = np.where(mark, (1 << KINDS) * 5 + data[first].astype(np.int64), shape * 5 + np.minimum(length, 4))
    for k in range(len(ROLES)):
        out[:-1, OWN + 2 * k] = np.where(worded, near[k] - WORDS + word, 0)
        out[:-1, OWN + 2 * k + 1] = near[k] + about
    return out


class Tokens:
    """The tokens of a run of texts: their first and last bytes, text and code, and each text's first token."""

    def __init__(self, data: np.ndarray, at: np.ndarray, buffer: pa.Buffer) -> None:
        kind = _CLASS[data]
        new = np.ones(len(data), bool)
        new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _MARK)
        new[at[:-1][at[:-1] < len(data)]] = True
        cuts = np.flatnonzero(new)
        whole = kind[cuts] != _BLANK if len(data) else np.zeros(0, bool)
        bounds = np.append(cuts, len(data)).astype(np.int32)
        every = pa.BinaryArray.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(bounds), buffer]).dictionary_encode()
        self.names = every.dictionary
        self.codes = every.indices.to_numpy()[whole]
        self.first, self.end = bounds[:-1][whole], bounds[1:][whole]
        self.begins = np.searchsorted(self.first, at[:-1])
        counts = np.diff(np.append(self.begins, len(self.codes)))
        self.text = np.repeat(np.arange(len(counts)), counts)
        self.place = np.arange(len(self.codes)) - np.repeat(self.begins, counts)
        self.after = np.repeat(counts, counts) - self.place - 1
        self.files = self._files(data, at, kind, counts)

    def _files(self, data: np.ndarray, at: np.ndarray, kind: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of the four features of each text."""
        total = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[at])
        size = np.maximum(1, np.diff(at))
        lines = total(data == 10) + 1
        digits = (data >= 48) & (data <= 57)
        steps = [np.log2(1 + 100 * total(kind == _MARK) / size), np.log2(1 + 100 * total(digits) / size), np.log2(1 + size / lines) / 2, np.log2(1 + size) / 4]
        return np.stack([FILES + FILE_STEPS * k + np.minimum(s.astype(np.int64), FILE_STEPS - 1) for k, s in enumerate(steps)], 1)

    def neighbours(self, codes: np.ndarray, edge: int) -> Iterator[np.ndarray]:
        """Codes of what stands 1, 2, 3 before and 1 after each token; ``edge`` beyond its text."""
        for k in (1, 2, 3):
            out = np.full(len(codes), edge, codes.dtype)
            out[k:] = codes[:-k] if k < len(codes) else []
            out[self.place < k] = edge
            yield out
        out = np.full(len(codes), edge, codes.dtype)
        out[:-1] = codes[1:]
        out[self.after < 1] = edge
        yield out


class Tagger:
    """What distinct tokens add to scores is looked up once a run of texts."""

    def __init__(self, weights: crf.Weights) -> None:
        self.weights = weights

    def table(self, names: pa.Array) -> np.ndarray:
        """(distinct tokens and the edge, as itself and each neighbour, 3)."""
        ids, w = described(names), self.weights.features
        parts = [w[ids[:, a:b]].sum(1) for a, b in [(0, OWN), *((OWN + 2 * k, OWN + 2 * k + 2) for k in range(len(ROLES)))]]
        return np.stack(parts, 1)

    def spans(self, data: np.ndarray, at: np.ndarray, buffer: pa.Buffer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, first byte, end) of runs of begin and inside."""
        found = Tokens(data, at, buffer)
        table = self.table(found.names)
        scores = table[found.codes, 0]
        for k, codes in enumerate(found.neighbours(found.codes, len(table) - 1)):
            scores += table[codes, 1 + k]
        scores += self.weights.features[found.files].sum(1)[found.text]
        tags = crf.viterbi(scores, found.begins, self.weights)
        starts = np.flatnonzero(tags == crf.BEGIN)
        inside = tags == crf.INSIDE
        stops = np.flatnonzero((tags != crf.OUT) & ~np.append(inside[1:], False))
        return found.text[starts], found.first[starts], found.end[stops]


def _windows(data: np.ndarray, at: np.ndarray, buffer: pa.Buffer, values: list[tuple[int, int]], salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(features (n, WINDOW, k), tags) of windows of one text, whose secrets are the bytes of ``values``: around secrets, and at hashed places."""
    own = Tokens(data, at, buffer)
    n = len(own.codes)
    tags = np.zeros(n, np.int64)
    for a, b in values:
        some = np.flatnonzero((own.first < b) & (own.end > a))
        tags[some] = crf.INSIDE
        tags[some[:1]] = crf.BEGIN
    centres = np.flatnonzero(tags == crf.BEGIN)
    picked = centres[:: max(1, len(centres) // WINDOWS)][:WINDOWS].tolist() + [zlib.crc32(f"{salt} {k}".encode()) % n for k in range(WINDOWS if len(centres) == 0 else 1)]
    names = described(own.names)
    features = [names[own.codes, :OWN]] + [names[codes, OWN + 2 * k : OWN + 2 * k + 2] for k, codes in enumerate(own.neighbours(own.codes, len(names) - 1))]
    features = np.concatenate([*features, np.repeat(own.files.astype(np.int32), n, 0)], 1)
    out, label = np.zeros((len(picked), WINDOW, features.shape[1]), np.int32), np.full((len(picked), WINDOW), -1, np.int64)
    for k, c in enumerate(picked):
        first = max(0, min(c - WINDOW // 2, n - WINDOW))
        size = min(WINDOW, n - first)
        out[k, :size], label[k, :size] = features[first : first + size], tags[first : first + size]
    # a window may not begin inside a secret
    label[:, 0] = np.where(label[:, 0] == crf.INSIDE, crf.BEGIN, label[:, 0])
    return out, label


def _in_bytes(text: bytes, values: list[tuple[int, int]]) -> list[tuple[int, int]]:
    data = np.frombuffer(text, np.uint8)
    cuts = Bits(starts_of_points(data)).select(np.array(values, np.int64).ravel())
    return [(int(a), int(b)) for a, b in cuts.reshape(-1, 2)]


def sampled(docs: DataFrame, text_col: str, sample_texts: int) -> DataFrame:
    """(h, hit, text) of the distinct texts that are learned from, ``h`` their hash: at most ``sample_texts`` with base spans, and so many without."""
    hashed = docs.select(F.xxhash64(f"`{text_col}`").alias("h"), F.col(f"`{text_col}`").alias("text")).where(F.length("text") > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base.forget()
        for batch in batches:
            hits = []
            for a, b in tokens.slices(batch.column(1)):
                some = batch.column(1).slice(a, b - a)
                hold = may_hold(some)
                hits += [bool(y) and bool(base_spans(some[k].as_py())) for k, y in enumerate(hold)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hits, pa.bool_())], ["h", "hit"])

    seen = base.written(hashed.mapInArrow(run, "h long, hit boolean").distinct(), "secret-texts")
    least = [seen.where(F.col("hit") == hit).orderBy("h").limit(sample_texts).agg(F.max("h")).first()[0] for hit in (True, False)]
    chosen = F.lit(False)
    for hit, h in zip((True, False), least):
        if h is not None:
            chosen = chosen | ((F.col("hit") == hit) & (F.col("h") <= h))
    # hashes only: at most two times sample_texts of them
    return hashed.join(F.broadcast(seen.where(chosen)), "h")


def fit(docs: DataFrame, text_col: str = "text", sample_texts: int = SAMPLE_TEXTS) -> crf.Weights | None:
    """The field's weights, or None where no text has a base span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base.forget()
        for batch in batches:
            for h, hit, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                t = text.as_py()
                raw = t.encode()
                data = np.frombuffer(raw, np.uint8)
                if not (_CLASS[data] != _BLANK).any():
                    continue
                values = _in_bytes(raw, [s[3:] for s in base_spans(t)]) if hit else []
                features, tags = _windows(data, np.array([0, len(raw)]), pa.py_buffer(raw), values, h)
                yield pa.RecordBatch.from_arrays([pa.array([h]), pa.array([features.tobytes()], pa.binary()), pa.array([tags.tobytes()], pa.binary())], ["h", "features", "tags"])

    found = sampled(docs, text_col, sample_texts).select("h", "hit", "text").mapInArrow(run, "h long, features binary, tags binary")
    rows = sorted((r["h"], bytes(r["features"]), bytes(r["tags"])) for r in found.groupBy("h").agg(F.first("features").alias("features"), F.first("tags").alias("tags")).toLocalIterator())
    if not rows:
        return None
    tags = np.concatenate([np.frombuffer(r[2], np.int64).reshape(-1, WINDOW) for r in rows])
    if not (tags == crf.BEGIN).any():
        return None
    features = np.concatenate([np.frombuffer(r[1], np.int32).reshape(-1, WINDOW, OWN + 2 * len(ROLES) + FILE_KINDS) for r in rows])
    bare = features[::BARE].copy()
    bare[:, :, OWN : OWN + 2 * len(ROLES)] = 0
    groups = [(0, OWN), *((OWN + 2 * k, OWN + 2 * k + 2) for k in range(len(ROLES))), (OWN + 2 * len(ROLES), features.shape[2])]
    return crf.fit(np.concatenate([features, bare]), np.concatenate([tags, tags[::BARE]]), SIZE, groups)


def _added(some: pa.Array, tagger: Tagger, taken: dict[int, list]) -> dict[int, list[tuple[int, int]]]:
    """By text: spans in code points that no base span (``taken``) contains."""
    data, at, buffer = view(some)
    text, first, end = tagger.spans(data, at, buffer)
    if not len(text):
        return {}
    points = Bits(starts_of_points(data))
    before = points.rank(at[text])
    out: dict[int, list[tuple[int, int]]] = {}
    for k, a, b in zip(text.tolist(), (points.rank(first) - before).tolist(), (points.rank(end) - before).tolist()):
        if not any(s[1] <= a and b <= s[2] for s in taken.get(k, ())):
            out.setdefault(k, []).append((a, b))
    return out


def found(docs: DataFrame, weights: crf.Weights | None, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """docs with ``spans``: base spans and those that the field adds, by start, then kind."""
    rest = [c for c in docs.columns if c.lower() != "spans" and (keep_text or c != text_col)]
    packed = docs.select(*[F.col(f"`{c}`") for c in rest], F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    # plain names inside: a column's own may hold dots
    schema = StructType([StructField(f"c{k}", f.dataType) for k, f in enumerate(packed.schema.fields[:-1])]).add("spans", SPANS)
    kinds = [kind for kind, *_ in BASE] + [ADDED]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base.forget()
        tagger = None if weights is None else Tagger(weights)
        for batch in batches:
            for a, b in tokens.slices(batch.column(len(rest))):
                part = batch.slice(a, b - a)
                some = part.column(len(rest))
                taken = {int(k): base_spans(some[int(k)].as_py()) for k in np.flatnonzero(may_hold(some))}
                more = {} if tagger is None else _added(some, tagger, taken)
                every = [sorted([(s[1], kinds.index(s[0]), s[2]) for s in taken.get(k, ())] + [(x, len(BASE), y) for x, y in more.get(k, ())]) if k in taken or k in more else [] for k in range(len(some))]
                spans = pa.array([[{"kind": kinds[k], "start": x, "end": y} for x, k, y in own] for own in every], pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], spans], schema.names)

    return packed.toDF(*schema.names[:-1], "_text").mapInArrow(run, schema).toDF(*rest, "spans")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op12_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = found(docs, fit(docs), keep_text=False)
    plain = F.filter("spans", lambda s: s["kind"] != ADDED)
    return out.select("doc_id", *[of_kind(kind).alias(f"n_{kind}") for kind, *_ in BASE], F.sha2(F.encode(joined(plain), "UTF-8"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
