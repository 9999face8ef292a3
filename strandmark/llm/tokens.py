"""Whole-text encoding with the tokenizers library, each distinct blank-separated piece only once.

Pre-tokenizers of both kinds of public files never join text across certain blanks, so a text's ids are the ids
of its pieces in a row:

* ``drops_space`` (word-end BPE): white space only separates words, so a text is cut at blanks and line feeds;
* otherwise (byte-level BPE): a word takes the one blank before it, so a text is cut at each blank and a piece
  stands for itself and that blank. A text in which a blank stands beside other white space is encoded whole.

A comma or full stop between a letter or digit and a blank is a piece of its own. Texts with the opening characters
of a special token, or where a rule above doesn't hold, are encoded whole. Cutting and finding the distinct pieces is
Arrow's work. New pieces go through the library as one long text; a piece's ids are found by the bytes that each id
stands for, and if those don't meet the pieces' ends, piece by piece. Ids equal those of
``Tokenizer.encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

from . import base

#: Distinct pieces kept per worker; beyond, those seen most often stay.
CACHE_PIECES = 250_000
#: New pieces that go through the library together.
_AT_ONCE = 25_000
#: Marks in front of a text, and for a comma and a full stop before a blank.
FIRST, COMMA, STOP = "\0", "\1", "\2"


class _Grown:
    """A numpy array that doubles when full."""

    def __init__(self, dtype) -> None:
        self.data, self.size = np.empty(1024, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.data):
            larger = np.empty(max(need, 2 * len(self.data)), self.data.dtype)
            larger[: self.size] = self.data[: self.size]
            self.data = larger
        self.data[self.size : need] = values
        self.size = need


def _ids(encoding) -> np.ndarray:
    return np.array(encoding.ids, np.uint32)


class Encoder:
    def __init__(self, path: str, drops_space: bool) -> None:
        from tokenizers import Tokenizer

        self.library, self.drops_space = Tokenizer.from_file(path), drops_space
        vocab = self.library.get_vocab()
        self.id_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.id_bytes[i] = len(token.removesuffix("</w>") if drops_space else token)
        self._clear()

    def _clear(self) -> None:
        self.names = pa.array([], pa.string())  # pieces by code
        self.ids, self.starts = _Grown(np.uint32), np.zeros(1, np.int32)  # a piece's ids lie between two starts
        self.alone, self.open, self.seen = _Grown(bool), _Grown(bool), _Grown(np.int64)
        for mark, text in ((COMMA, ","), (STOP, ".")):
            own = _ids(self.library.encode(text, add_special_tokens=False))
            self._add(pa.array([mark]), own, np.array([len(own)]), False)

    def _add(self, pieces: pa.Array, ids: np.ndarray, lengths: np.ndarray, alone: bool) -> None:
        if not len(pieces):
            return
        self.names = pa.concat_arrays([self.names, pieces])
        self.starts = np.concatenate([self.starts, (self.ids.size + np.cumsum(lengths)).astype(np.int32)])
        self.ids.extend(ids)
        self.alone.extend(np.full(len(pieces), alone))
        self.open.extend(pc.invert(pc.utf8_is_alnum(pc.utf8_slice_codeunits(pieces, -1, None))).to_numpy(zero_copy_only=False))
        self.seen.extend(np.zeros(len(pieces), np.int64))

    def _lists(self) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(self.starts), pa.array(self.ids.data[: self.ids.size]))

    def _shrink(self) -> None:
        """Keeps the more frequent half, in old order."""
        n = len(self.names)
        seen = self.seen.data[:n].copy()
        seen[:2] = np.iinfo(np.int64).max
        keep = np.sort(np.argpartition(-seen, CACHE_PIECES // 2)[: CACHE_PIECES // 2])
        own = self._lists().take(pa.array(keep))
        alone, opened, names = self.alone.data[keep], self.open.data[keep], self.names.take(pa.array(keep))
        self.names, self.starts = names, own.offsets.to_numpy().copy()
        self.ids, self.alone, self.open, self.seen = _Grown(np.uint32), _Grown(bool), _Grown(bool), _Grown(np.int64)
        for grown, values in ((self.ids, own.flatten().to_numpy()), (self.alone, alone), (self.open, opened), (self.seen, seen[keep] // 2)):
            grown.extend(values)

    def _classes(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For each piece: whether it begins a text; whether texts with it must be encoded whole."""
        head = pc.starts_with(new, FIRST)
        own = pc.if_else(head, pc.utf8_slice_codeunits(new, 1), new)
        alone = pc.match_substring(own, "<|")
        for mark in (FIRST, COMMA, STOP):
            alone = pc.or_(alone, pc.match_substring(own, mark))
        if not self.drops_space:
            bare = pc.binary_length(pc.utf8_trim_whitespace(own))
            alone = pc.or_(alone, pc.or_(pc.equal(bare, 0), pc.not_equal(bare, pc.binary_length(own))))
        return head.to_numpy(zero_copy_only=False), alone.to_numpy(zero_copy_only=False)

    def _sizes(self, plain: pa.Array) -> np.ndarray:
        """Bytes that each piece's ids stand for."""
        sizes = pc.binary_length(plain).to_numpy().astype(np.int64)
        if not self.drops_space:
            return sizes + 1
        for k in np.flatnonzero(~pc.and_(pc.string_is_ascii(plain), pc.invert(pc.match_substring_regex(plain, r"\s"))).to_numpy(zero_copy_only=False)):
            sizes[k] = len("".join(unicodedata.normalize("NFC", plain[int(k)].as_py()).lower().split()).encode())
        return sizes

    def _many(self, texts: list[str]) -> list[np.ndarray]:
        return [_ids(e) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: pa.Array) -> np.ndarray:
        """Adds the pieces; their codes."""
        head, alone = self._classes(new)
        kinds = [np.flatnonzero(x) for x in (~head & ~alone, head & ~alone, alone)]
        plain, first, odd = (new.take(pa.array(k)) for k in kinds)
        codes = np.empty(len(new), np.int32)
        codes[np.concatenate(kinds)] = len(self.names) + np.arange(len(new))
        if len(plain):
            blank = "" if self.drops_space else " "
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(plain)], pa.int32()), plain), " ")[0].as_py()
            flat = self._many([blank + joined])[0]
            ends = np.concatenate(([0], np.cumsum(self.id_bytes[flat])))
            want = np.cumsum(self._sizes(plain))
            at = np.searchsorted(ends, want)
            if at[-1] == len(flat) and np.array_equal(ends[at], want):
                self._add(plain, flat, np.diff(at, prepend=0), False)
            else:
                self._add_each(plain, [blank + p for p in plain.to_pylist()])
        self._add_each(first, [p[1:] for p in first.to_pylist()])
        self._add(odd, np.zeros(0, np.uint32), np.zeros(len(odd), np.int64), True)
        return codes

    def _add_each(self, pieces: pa.Array, texts: list[str]) -> None:
        if texts:
            ids = self._many(texts)
            self._add(pieces, np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids)), False)

    def _wrong(self, codes: np.ndarray, distinct: np.ndarray) -> np.ndarray:
        """Places of pieces that break a rule in their text."""
        marks = np.flatnonzero(codes < 2)
        marks = marks[marks > 0]
        found = marks[self.open.data[codes[marks - 1]]]
        return np.append(found, np.flatnonzero(self.alone.data[codes])) if self.alone.data[distinct].any() else found

    def encode(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's begin (one more entry than texts). Null is empty."""
        if len(self.names) > CACHE_PIECES:
            self._shrink()
        texts = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "")
        cut = pc.replace_substring(texts, "\n", " ") if self.drops_space else pc.binary_join_element_wise(FIRST, texts, "")
        for mark, text in ((COMMA, ", "), (STOP, ". ")):
            cut = pc.replace_substring(cut, text, f" {mark} ")
        cut = pc.split_pattern(cut, " ")
        bounds = cut.offsets.to_numpy().astype(np.int64)
        pieces = cut.flatten().dictionary_encode()
        bounds -= bounds[0] if len(bounds) else 0
        known = pc.fill_null(pc.index_in(pieces.dictionary, value_set=self.names), -1).to_numpy().copy()
        new = np.flatnonzero(known < 0)
        for k in range(0, len(new), _AT_ONCE):
            part = new[k : k + _AT_ONCE]
            known[part] = self._learn(pieces.dictionary.take(pa.array(part)))
        codes = known[pieces.indices.to_numpy()]
        self.seen.data[: self.seen.size] += np.bincount(codes, minlength=self.seen.size)
        lists = self._lists().take(pa.array(codes))
        flat, at = lists.flatten().to_numpy(), lists.offsets.to_numpy()[bounds].astype(np.int64)
        wrong = self._wrong(codes, known)
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        marked = pc.or_(pc.match_substring(texts, COMMA), pc.match_substring(texts, STOP)).to_numpy(zero_copy_only=False)
        broken = np.zeros(len(texts), bool)
        broken[np.searchsorted(bounds, wrong, side="right") - 1] = True
        whole = np.flatnonzero((broken | marked) & ~empty)
        if len(whole):
            parts = [flat[a:b] for a, b in zip(at, at[1:])]
            for k, ids in zip(whole, self._many(texts.take(pa.array(whole)).to_pylist())):
                parts[k] = ids
            flat, at = np.concatenate(parts), np.concatenate(([0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))))
        return flat, at


def encoder(name: str, drops_space: bool) -> Encoder:
    """This worker's encoder for a public tokenizer file; it's kept until the worker needs another tool, or none."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    key = (public_tokenizers.path(name), drops_space)
    return base.tool(key, lambda: Encoder(*key))


def slices(texts: pa.Array, most: int = 3_000_000):
    """(first, last) of runs of texts with about ``most`` bytes at most (a longer text stands alone)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    first = 0
    while first < len(ends):
        base.give_back()
        done = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield first, last
        first = last
