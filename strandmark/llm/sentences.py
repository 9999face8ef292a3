"""Operator 4: SentencePiece encoding with seeded merge-dropout, and lossless decoding.

The merge type: a text is a blank and its characters, blanks written as U+2581, and adjacent symbols are merged in order
of the merged piece's score (the leftmost of equal ones) while it's in the vocabulary. With dropout a candidate merge
that comes up in the agenda is skipped where a keyed hash of the seed, the document's key, the word's place in the document
and the merge's span and split is below the rate, so every occurrence of a word is segmented by draws of its own. Rate
0 gives the library's own ids.

What is kept of a word is the tree of its agendas: the merges that are made if nothing is skipped, and for each of them the
agenda that follows if that one is skipped, and so on. An occurrence draws for the merges of the first agenda in their
order; at the first that is skipped it goes on to that branch, till it comes to an agenda of which nothing is skipped.
Branches are segmented when an occurrence first gets there, many at a time, so the tree saves work and decides nothing.

Merges never cross from a character into the blank after it (checked against the vocabulary), so words with the blanks
before them are segmented apart. All new agendas of a batch advance together, a merge a step, as rows of a matrix; long
words, and those with U+2581 itself, use a queue of their own. Characters outside the vocabulary, and U+2581 itself, become their UTF-8 bytes'
pieces, which makes decoding lossless.

Edge cases: null and empty texts have no ids and decode to the empty text; a null key is a key like any other; repeated
rows give equal ids; other columns are carried, those named like a result are replaced; an empty table gives an empty
table.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import base, tokens

BLANK = "▁"
#: Agendas kept per worker.
CACHE_NODES = 700_000
_NONE = np.int32(1 << 30)
_UNITS = re.compile(r" *[^ ]+| +")
_WIDTHS = (8, 12, 16, 24, 40)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _coded(start, split, end):
    """A candidate merge within its word."""
    return start << 16 | split << 8 | end


class Numbers:
    """A hash table from numbers (0 and more) to numbers, for arrays at a time; it doubles when half full."""

    def __init__(self, bits: int = 12) -> None:
        self.used = 0
        self._empty(bits)

    def _empty(self, bits: int) -> None:
        self.bits, self.keys, self.values = bits, np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Their values; -1 for those that aren't there."""
        at = self._slots(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], -1)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """New, distinct keys."""
        self.used += len(keys)
        if 2 * self.used > len(self.keys):
            kept = self.keys >= 0
            keys, values = np.concatenate((self.keys[kept], keys)), np.concatenate((self.values[kept], values))
            self._empty(max(self.bits + 1, (2 * self.used).bit_length()))
        at = self._slots(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # of several that want a place one gets it
            own = self.keys[at] == keys
            self.values[at[own]] = values[own]
            keys, values, at = keys[~own], values[~own], (at[~own] + 1) & ((1 << self.bits) - 1)


class Vocabulary:
    """Pieces, and which pairs merge into which; found from the model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in normal}
        self.byte = np.zeros(256, np.int32)
        for i in range(n):
            if model.is_byte(i):
                self.byte[int(self.pieces[i][3:-1], 16)] = i
        self.of_byte = {int(i): b for b, i in enumerate(self.byte)}
        if any(BLANK in p.lstrip(BLANK) for p in self.ids):
            raise ValueError("a piece goes on over a blank")
        by_score = sorted(normal, key=lambda i: (-model.get_score(i), i))
        rank = {i: k for k, i in enumerate(by_score)}
        # equal scores are equal ranks: the leftmost wins
        for a, b in zip(by_score, by_score[1:]):
            if model.get_score(a) == model.get_score(b):
                rank[b] = rank[a]
        pairs = {}
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                a, b = self.ids.get(p[:k]), self.ids.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * n + b] = (rank[i], i)
        self.size, self.pairs = n, pairs
        self.ranks, self.merged = np.array([*pairs.values(), (_NONE, 0)], np.int32).T.copy()
        self.table = Numbers()
        self.table.put(np.array(list(pairs), np.int64), np.arange(len(pairs)))
        self.start = np.full(0x110000, -1, np.int32)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.start[ord(p)] = i
        self.bytes_of = [bytes([self.of_byte[i]]) if i in self.of_byte else p.replace(BLANK, " ").encode() for i, p in enumerate(self.pieces)]

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged piece) of pairs; rank _NONE where they don't merge."""
        at = self.table.get(np.where((left >= 0) & (right >= 0), left.astype(np.int64) * self.size + right, 1 << 62))
        return self.ranks[at], self.merged[at]


class Segmenter:
    """Agendas of words with given merges skipped; a word is a run of blanks (as U+2581) and what follows."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary

    def segment(self, words: list[str], skipped: list[tuple[int, ...]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(numbers of words, all their ids, how many each has, all their merges in order, how many) in parts; words of up to
        _WIDTHS[-1] characters and without U+2581 as such."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        done = 0
        for width in _WIDTHS:
            part = np.flatnonzero((size > done) & (size <= width))
            done = width
            for a in range(0, len(part), 20_000):
                some = part[a : a + 20_000]
                yield some, *self._matrix([words[k] for k in some.tolist()], [skipped[k] for k in some.tolist()], size[some], width)

    def _matrix(self, words: list[str], skipped: list[tuple[int, ...]], size: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A row a word, a column a character: a symbol stands where it starts, ``after`` and ``before`` are its neighbours."""
        n = len(words)
        chars = np.frombuffer("".join([w.ljust(width, "\0") for w in words]).encode("utf-32-le"), np.uint32)
        inside = np.arange(width) < size[:, None]
        symbol = np.where(inside, self.v.start[chars].reshape(n, width), -2).ravel()
        after = np.tile(np.arange(1, width + 1, dtype=np.int32), n)
        before = after - 2
        rank = np.full(n * width, _NONE, np.int32)
        merged = np.zeros(n * width, np.int32)
        never = np.full((n, max(map(len, skipped), default=0)), -1, np.int32)
        for k, own in enumerate(skipped):
            never[k, : len(own)] = own

        def renew(r: np.ndarray, c: np.ndarray) -> None:
            f = r * width + c
            d = after[f]
            k, m = self.v.look_up(symbol[f], symbol[f - c + d])
            if never.shape[1]:
                k = np.where((never[r] == _coded(c, d, after[f - c + d])[:, None]).any(axis=1), _NONE, k)
            rank[f], merged[f] = k, m

        renew(*np.nonzero(inside[:, 1:]))
        live, made = np.arange(n), []
        grid = rank.reshape(n, width)
        while len(live):
            best = grid[live].argmin(axis=1)
            f = live * width + best
            go = rank[f] < _NONE
            live, best, f = live[go], best[go], f[go]
            if not len(live):
                break
            d = after[f]
            g = f - best + d
            end = after[g]
            made.append((live, _coded(best, d, end)))
            symbol[f], symbol[g], rank[f], rank[g], after[f] = merged[f], -2, _NONE, _NONE, end
            right = np.flatnonzero(end < size[live])
            before[live[right] * width + end[right]] = best[right]
            left = np.flatnonzero(before[f] >= 0)
            renew(np.concatenate((live[right], live[left])), np.concatenate((best[right], before[f[left]])))
        symbol = symbol.reshape(n, width)
        kept = symbol != -2
        ids, counts = symbol[kept], kept.sum(axis=1)
        if len(bare := np.flatnonzero(ids == -1)):  # characters that become bytes
            at = np.flatnonzero(kept)[bare]
            own = [self.v.byte[list(chr(c).encode())] for c in chars[at].tolist()]
            size = np.ones(len(ids), np.int64)
            size[bare] = list(map(len, own))
            counts = counts + np.bincount(at // width, size[bare] - 1, n).astype(np.int64)
            ids = np.repeat(ids, size)
            ids[np.repeat((np.cumsum(size) - size)[bare], size[bare]) + np.concatenate([np.arange(len(x)) for x in own])] = np.concatenate(own)
        rows = np.concatenate([x for x, _ in made]) if made else np.zeros(0, np.int64)
        codes = np.concatenate([x for _, x in made]) if made else rows
        return ids, counts, codes[np.argsort(rows, kind="stable")].astype(np.int32), np.bincount(rows, minlength=n)

    def with_bytes(self, ids, at, word: str) -> np.ndarray:
        flat: list[int] = []
        for i, a in zip(ids.tolist(), at.tolist()):
            flat += [i] if i >= 0 else self.v.byte[list(word[a].encode())].tolist()
        return np.array(flat, np.int32)

    def queue(self, word: str, skips, blanks: int | None = None) -> np.ndarray:
        """The ids of one word by a priority queue of candidate merges; skips: of (start, split, end), whether it's skipped.

        blanks: so many first U+2581 are blanks, any other one is the character itself, which becomes bytes."""
        n, v = len(word), self.v
        blanks = len(word) - len(word.lstrip(BLANK)) if blanks is None else blanks
        symbol = [int(v.start[ord(c)]) if k < blanks or c != BLANK else -1 for k, c in enumerate(word)]
        end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(a: int) -> None:
            b = end[a]
            if b < n and symbol[a] >= 0 and symbol[b] >= 0 and (found := v.pairs.get(symbol[a] * v.size + symbol[b])):
                heapq.heappush(agenda, (found[0], a, b, end[b], found[1]))

        for a in range(n - 1):
            offer(a)
        while agenda:
            _, a, b, e, piece = heapq.heappop(agenda)
            if not (alive[a] and b < n and alive[b] and end[a] == b and end[b] == e) or skips(a, b, e):
                continue
            symbol[a], end[a], alive[b] = piece, e, False
            if e < n:
                before[e] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        where = [a for a in range(n) if alive[a]]
        return self.with_bytes(np.array([symbol[a] for a in where]), np.array(where), word)


class Agendas:
    """The trees of agendas of all words so far. An agenda has its ids and the merges that are made after the last skip."""

    def __init__(self, segmenter: Segmenter) -> None:
        self.segmenter = segmenter
        self.roots: dict[str, int] = {}
        self.words: list[str] = []
        self.skipped: list[tuple[int, ...]] = []
        self.known = tokens._Grown(np.int64)  # merges made before the last skip
        self.branches = Numbers()
        self.ids, self.merges = tokens._Grown(np.int32), tokens._Grown(np.int32)
        self.id_at, self.merge_at = tokens._Grown(np.int64), tokens._Grown(np.int64)
        for grown in (self.id_at, self.merge_at):
            grown.extend(np.zeros(1, np.int64))

    def _add(self, words: list[str], skipped: list[tuple[int, ...]], known: np.ndarray) -> np.ndarray:
        """Adds an agenda for each; known: so many merges come before the last skip. Their numbers."""
        numbers = np.empty(len(words), np.int64)
        for some, ids, id_counts, merges, merge_counts in self.segmenter.segment(words, skipped):
            numbers[some] = len(self.words) + np.arange(len(some))
            self.words += [words[k] for k in some.tolist()]
            self.skipped += [skipped[k] for k in some.tolist()]
            self.known.extend(known[some])
            left = merge_counts - known[some]
            first = np.cumsum(merge_counts) - merge_counts + known[some]
            own = np.arange(int(left.sum())) + np.repeat(first - (np.cumsum(left) - left), left)
            for grown, at, values, counts in ((self.ids, self.id_at, ids, id_counts), (self.merges, self.merge_at, merges[own], left)):
                at.extend(grown.size + np.cumsum(counts))
                grown.extend(values)
        return numbers

    def root(self, words: list[str]) -> np.ndarray:
        new = [w for w in words if w not in self.roots]
        if new:
            plain = [BLANK * (len(w) - len(w.lstrip(" "))) + w.lstrip(" ") for w in new]
            self.roots.update(zip(new, self._add(plain, [()] * len(new), np.zeros(len(new), np.int64)).tolist()))
        return np.array([self.roots[w] for w in words], np.int64)

    def branch(self, nodes: np.ndarray, which: np.ndarray) -> np.ndarray:
        """The agendas after those in which the merge of this number is skipped."""
        keys = nodes << 8 | which
        out = self.branches.get(keys)
        if (out < 0).any():
            new = np.unique(keys[out < 0])
            parents, own = (new >> 8).tolist(), new & 255
            merge = self.merges.data[self.merge_at.data[new >> 8] + own].tolist()
            skipped = [(*self.skipped[p], m) for p, m in zip(parents, merge)]
            # up to the skip the agenda is that of the parent
            self.branches.put(new, self._add([self.words[p] for p in parents], skipped, self.known.data[new >> 8] + own))
            out = self.branches.get(keys)
        return out


class Encoder:
    def __init__(self, path: str, rate: float, seed: int) -> None:
        self.v, self.rate, self.seed = Vocabulary(path), rate, seed
        self.limit = np.uint64(min(int(rate * 2.0**64), 2**64 - 1))
        self.segmenter = Segmenter(self.v)
        self.agendas = Agendas(self.segmenter)
        self.piece_bytes = np.array(self.v.bytes_of, object)

    def salt(self, key: object) -> int:
        return xxhash.xxh64_intdigest(f"{self.seed}:{key}".encode())

    def skipped(self, place: np.ndarray, merge: np.ndarray) -> np.ndarray:
        """Whether a word's place (hashed with the document) skips this merge."""
        return _mix(_mix(place ^ merge.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))) < self.limit

    def _walk(self, nodes: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The agenda that each occurrence comes to from its word's first one."""
        nodes, open_ = nodes.copy(), np.arange(len(nodes))
        trees = self.agendas
        while len(open_) and self.limit:
            at = nodes[open_]
            first = trees.merge_at.data[at]
            many = trees.merge_at.data[at + 1] - first
            some = many > 0
            open_, at, first, many = open_[some], at[some], first[some], many[some]
            if not len(open_):
                break
            heads = np.cumsum(many) - many
            which = np.arange(int(many.sum())) - np.repeat(heads, many)
            hit = self.skipped(np.repeat(places[open_], many), trees.merges.data[np.repeat(first, many) + which])
            least = np.minimum.reduceat(np.where(hit, which, 1 << 30), heads)
            go = least < 1 << 30
            open_ = open_[go]
            if len(open_):
                nodes[open_] = trees.branch(at[go], least[go])
        return nodes

    def encode(self, texts: pa.Array, salts: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's begin; salts: of the documents' keys."""
        texts = pc.fill_null(texts, "")
        odd = pc.or_(pc.match_substring(texts, "  "), pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " "))).to_numpy(zero_copy_only=False)
        if odd.any():
            words = [_UNITS.findall(" " + t) if t else [] for t in texts.to_pylist()]
            counts = np.fromiter(map(len, words), np.int64, len(words))
            pieces = pa.array([w for x in words for w in x], pa.string()).dictionary_encode()
            distinct = pieces.dictionary.to_pylist()
        else:
            cut = pc.split_pattern(texts, " ")
            empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
            counts = np.where(empty, 0, np.diff(cut.offsets.to_numpy()))
            pieces = cut.filter(pa.array(~empty)).flatten().dictionary_encode()
            distinct = [" " + p for p in pieces.dictionary.to_pylist()]
        if len(self.agendas.words) > CACHE_NODES:
            self.agendas = Agendas(self.segmenter)
        codes = pieces.indices.to_numpy().astype(np.int64)
        salts = np.broadcast_to(np.asarray(salts, np.uint64), len(texts))
        starts = np.cumsum(counts) - counts
        place = np.arange(len(codes)) - np.repeat(starts, counts)
        place = _mix(np.repeat(salts, counts) + place.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
        alone = np.fromiter((len(w) > _WIDTHS[-1] or BLANK in w for w in distinct), bool, len(distinct))
        trees = self.agendas
        roots = np.zeros(len(distinct), np.int64)
        roots[~alone] = trees.root([w for w, a in zip(distinct, alone) if not a])
        usual = np.flatnonzero(~alone[codes]) if alone.any() else np.arange(len(codes))
        nodes = self._walk(roots[codes[usual]], place[usual])
        at, flat = trees.id_at.data[nodes], trees.ids.data
        n = np.zeros(len(codes), np.int64)
        n[usual] = trees.id_at.data[nodes + 1] - at
        single = {k: self._alone(distinct[codes[k]], place[k]) for k in np.flatnonzero(alone[codes]).tolist()}
        for k, ids in single.items():
            n[k] = len(ids)
        ends = np.cumsum(n)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        begin = ends - n
        where = np.arange(int(n[usual].sum())) - np.repeat(np.cumsum(n[usual]) - n[usual], n[usual])
        out[np.repeat(begin[usual], n[usual]) + where] = flat[np.repeat(at, n[usual]) + where]
        for k, ids in single.items():
            out[begin[k] : ends[k]] = ids
        return out, np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]

    def _alone(self, word: str, place: np.uint64) -> np.ndarray:
        """The ids of one occurrence of a word that has no tree."""
        blanks = len(word) - len(word.lstrip(" "))

        def skips(a: int, b: int, e: int) -> bool:
            span = np.array([xxhash.xxh64_intdigest(struct.pack("<3Q", a, b, e))], np.uint64)
            return bool(self.limit) and bool(self.skipped(np.array([place], np.uint64), span)[0])

        return self.segmenter.queue(BLANK * blanks + word[blanks:], skips, blanks)

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids."""
        return b"".join(self.piece_bytes[ids].tolist()).decode()[1:]


def encoder(name: str, rate: float, seed: int) -> Encoder:
    key = (public_tokenizers.path(name), rate, seed)
    return base.tool(key, lambda: Encoder(*key))


def encoded(docs: DataFrame, model: str, rate: float, seed: int, key: str = "doc_id", text: str = "text", decoded: bool = False, with_ids: bool = True) -> DataFrame:
    """docs without the text and with ``n_ids, ids_crc32[, ids][, decoded_sha256]``; ids are 4-byte little-endian."""
    added = {"n_ids": "long", "ids_crc32": "long"} | ({"ids": "binary"} if with_ids else {}) | ({"decoded_sha256": "string"} if decoded else {})
    docs = docs.withColumnRenamed(text, "_text")
    rest = [c for c in docs.columns if c not in added and c != "_text"]
    at = rest.index(key)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*rest).schema.fields] + [f"{n} {t}" for n, t in added.items()])
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(model, rate, seed)
        for batch in batches:
            salts = np.array([tool.salt(k.as_py()) for k in batch.column(at)], np.uint64)
            texts = batch.column(len(rest))
            for i, j in tokens.slices(texts):
                base.give_back()
                ids, starts = tool.encode(texts[i:j], salts[i:j])
                ids = ids.astype("<u4")
                own = [ids[a:b] for a, b in zip(starts, starts[1:])]
                made = {"n_ids": [len(x) for x in own], "ids_crc32": [zlib.crc32(x.tobytes()) for x in own]}
                if with_ids:
                    made["ids"] = [x.tobytes() for x in own]
                if decoded:
                    made["decoded_sha256"] = [hashlib.sha256(tool.decode(x).encode()).hexdigest() for x in own]
                yield pa.RecordBatch.from_arrays([*(c[i:j] for c in batch.columns[: len(rest)]), *(pa.array(made[n], kinds[t]) for n, t in added.items())], [*rest, *added])

    return docs.select(*rest, "_text").mapInArrow(run, schema)


def decoded(df: DataFrame, model: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """df with the text of its id column (4-byte little-endian) in the place of it; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(model, 0.0, 0)
        for batch in batches:
            texts = [None if x is None else tool.decode(np.frombuffer(x, "<u4")) for x in batch.column(len(rest)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], pa.array(texts, pa.string())], [*rest, text])

    rest = [c for c in df.columns if c not in (ids, text)]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*rest).schema.fields] + [f"`{text}` string"])
    return df.select(*rest, F.col(ids)).mapInArrow(run, schema)


def op4_sentencepiece(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encoded(docs, "piece_bpe_32k.model", 0.1, 13, decoded=True, with_ids=False)
