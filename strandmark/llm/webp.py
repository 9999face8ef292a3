"""Lossless WebP (VP8L) streams: a decoder for all of the format, an encoder, and both for many images at once.

Pixels are uint8 arrays (height, width, 4) in the order A, R, G, B. ``decode`` reads prefix codes (simple and normal,
several groups), back-references, the colour cache, and inverts the predictor, cross-colour, subtract-green and palette
transforms. ``encode`` writes any of these, one image at a time.

``encode_many`` stores grey images. Of each it chooses the transforms by what entropy they leave (cross-colour, which makes
red and blue nothing; predictors; a palette; the colour cache instead), finds back-references and writes prefix codes.
``decode_many`` reads any image: those whose literals are one code, as all but a few of encode_many's are, advance together,
a literal or reference a step, and their transforms are inverted together; others go through ``decode`` one by one.
"""

from __future__ import annotations

import functools
import struct
from collections import Counter
from dataclasses import dataclass

import numpy as np

MAX_SIDE = 1 << 14
LENGTH_CODES, DISTANCE_CODES = 24, 40
# Fixed values of the format: the order in which lengths of the code-length code are stored.
LENGTH_ORDER = [17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15]
CACHE_MULTIPLIER = 0x1E35A7BD
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)
#: Near neighbours (x, y) by distance code: the nearest first, then the smaller |x|, then the positive x.
NEAR = sorted(((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), -p[0]))


class Reader:
    def __init__(self, data: bytes) -> None:
        self.data, self.at = data, 0

    def peek(self, n: int) -> int:
        a = self.at >> 3
        return (int.from_bytes(self.data[a : a + 8], "little") >> (self.at & 7)) & ((1 << n) - 1)

    def read(self, n: int) -> int:
        v = self.peek(n)
        self.at += n
        if self.at > 8 * len(self.data):
            raise ValueError("the stream ends too early")
        return v


class Writer:
    def __init__(self) -> None:
        self.value, self.at = 0, 0
        self.out = bytearray()

    def write(self, v: int, n: int) -> None:
        self.value |= v << self.at
        self.at += n
        while self.at >= 8:
            self.out.append(self.value & 255)
            self.value >>= 8
            self.at -= 8

    def done(self) -> bytes:
        return bytes(self.out) + (bytes([self.value & 255]) if self.at else b"")


def turned(v: int, n: int) -> int:
    return int(f"{v:0{n}b}"[::-1], 2) if n else 0


@functools.cache
def _reversed_index(bits: int) -> np.ndarray:
    """Each number of so many bits, turned."""
    out = np.zeros(1, np.int64)
    for _ in range(bits):
        out = np.concatenate((2 * out, 2 * out + 1))
    return out


def canonical(lengths) -> list[int]:
    """Each symbol's code, its first bit lowest; ValueError if the lengths don't make a whole code."""
    out, code = [0] * len(lengths), 0
    used = sorted((n, s) for s, n in enumerate(lengths) if n)
    if len(used) == 1:
        return out
    last = 0
    for n, s in used:
        code <<= n - last
        last = n
        out[s] = turned(code, n)
        code += 1
    if used and code != 1 << last:
        raise ValueError("not a whole prefix code")
    return out


def canonical_many(lengths: np.ndarray) -> np.ndarray:
    """``canonical`` of each row."""
    row, symbol = np.nonzero(lengths)
    n = lengths[row, symbol].astype(np.int64)
    order = np.lexsort((symbol, n, row))
    row, symbol, n = row[order], symbol[order], n[order]
    share = 1 << 15 - n
    before = np.cumsum(share) - share
    first = np.searchsorted(row, np.arange(len(lengths)))
    # a code is the share of all codes before it, in its first n of 15 bits; turned, these are the last ones
    code = before - np.append(before, 0)[first][row]
    out = np.zeros(lengths.shape, np.uint64)
    out[row, symbol] = _reversed_index(15)[code]
    return out


class Prefix:
    """A prefix code for reading; bounded: its stored form doesn't depend on the alphabet's size."""

    def __init__(self, lengths, bounded: bool = True) -> None:
        self.bounded = bounded
        self.lengths = list(lengths)
        used = [s for s, n in enumerate(self.lengths) if n]
        self.only = used[0] if len(used) == 1 else 0 if not used else None
        self.bits = 0 if self.only is not None else max(self.lengths)
        if self.bits:
            self.table: list[tuple[int, int]] = [(0, 0)] * (1 << self.bits)
            for s, code in enumerate(canonical(self.lengths)):
                if n := self.lengths[s]:
                    self.table[code :: 1 << n] = [(s, n)] * (1 << self.bits - n)

    def read(self, r: Reader) -> int:
        if self.only is not None:
            return self.only
        s, n = self.table[r.peek(self.bits)]
        r.read(n)
        return s


def read_prefix(r: Reader, alphabet: int) -> Prefix:
    lengths = [0] * alphabet
    if r.read(1):
        two, wide = r.read(1), r.read(1)
        symbols = [r.read(8 if wide else 1)]
        if two:
            symbols.append(r.read(8))
        for s in symbols:
            lengths[s] = 1
        return Prefix(lengths)
    own = [0] * 19
    for k in range(4 + r.read(4)):
        own[LENGTH_ORDER[k]] = r.read(3)
    code = Prefix(own)
    bounded = bool(r.read(1))
    left = 2 + r.read(2 + 2 * r.read(3)) if bounded else alphabet
    at, before = 0, 8
    while at < alphabet and left:
        left -= 1
        s = code.read(r)
        if s < 16:
            lengths[at] = s
            at += 1
            before = s or before
        else:
            n, value = {16: (3, before), 17: (3, 0), 18: (11, 0)}[s]
            n += r.read({16: 2, 17: 3, 18: 7}[s])
            if at + n > alphabet:
                raise ValueError("code lengths run over")
            lengths[at : at + n] = [value] * n
            at += n
    return Prefix(lengths, bounded)


def read_amount(r: Reader, code: int) -> int:
    if code < 4:
        return code + 1
    extra = (code - 2) >> 1
    return ((2 + (code & 1)) << extra) + r.read(extra) + 1


def cells(side: int, bits: int) -> int:
    return -(-side // (1 << bits))


def read_image(r: Reader, width: int, height: int, main: bool) -> list[int]:
    cache_bits = r.read(4) if r.read(1) else 0
    if cache_bits > 11:
        raise ValueError("colour cache size")
    cache = [0] * (1 << cache_bits) if cache_bits else []
    group_bits, which = 0, None
    if main and r.read(1):
        group_bits = r.read(3) + 2
        which = [(p >> 8) & 0xFFFF for p in read_image(r, cells(width, group_bits), cells(height, group_bits), False)]
    sizes = (256 + LENGTH_CODES + len(cache), 256, 256, 256, DISTANCE_CODES)
    groups = [[read_prefix(r, n) for n in sizes] for _ in range(max(which, default=0) + 1 if which else 1)]
    out: list[int] = []
    total, across = width * height, cells(width, group_bits)
    group = groups[0]

    def store(p: int) -> None:
        out.append(p)
        if cache:
            cache[(CACHE_MULTIPLIER * p & 0xFFFFFFFF) >> 32 - cache_bits] = p

    while len(out) < total:
        if which:
            y, x = divmod(len(out), width)
            group = groups[which[(y >> group_bits) * across + (x >> group_bits)]]
        s = group[0].read(r)
        if s < 256:
            red, blue, alpha = group[1].read(r), group[2].read(r), group[3].read(r)
            store(alpha << 24 | red << 16 | s << 8 | blue)
        elif s < 256 + LENGTH_CODES:
            length = read_amount(r, s - 256)
            d = read_amount(r, group[4].read(r))
            if d <= len(NEAR):
                x, y = NEAR[d - 1]
                d = max(1, x + y * width)
            else:
                d -= len(NEAR)
            if d > len(out) or len(out) + length > total:
                raise ValueError("a back-reference leaves the image")
            for _ in range(length):
                store(out[-d])
        else:
            store(cache[s - 256 - LENGTH_CODES])
    return out


def as_array(pixels: list[int], width: int, height: int) -> np.ndarray:
    return np.array(pixels, ">u4").view(np.uint8).reshape(height, width, 4)


def predict(mode: int, left, top, right, corner) -> np.ndarray:
    """From the neighbours' four channels, as ints."""
    half = lambda a, b: (a + b) >> 1
    if mode == 11:
        return left if np.abs(top - corner).sum() < np.abs(left - corner).sum() else top
    if mode == 12:
        return np.clip(left + top - corner, 0, 255)
    if mode == 13:
        a = half(left, top)
        return np.clip(a + np.trunc((a - corner) / 2).astype(int), 0, 255)
    return {
        0: lambda: np.array([255, 0, 0, 0]), 1: lambda: left, 2: lambda: top, 3: lambda: right, 4: lambda: corner, 5: lambda: half(half(left, right), top), 6: lambda: half(left, corner),
        7: lambda: half(left, top), 8: lambda: half(corner, top), 9: lambda: half(top, right), 10: lambda: half(half(left, corner), half(top, right)),
    }[mode]()


def predictor(image: np.ndarray, modes: np.ndarray, bits: int, forward: bool) -> np.ndarray:
    """Adds (or, forward, takes off) each pixel's prediction; modes: by block."""
    h, w, _ = image.shape
    if not forward and modes.size and modes.min() == modes.max() and modes.flat[0] in (1, 2):
        # left or above throughout: sums along one side, then from there on
        out = image.copy()
        out[0, 0] += np.array([255, 0, 0, 0], np.uint8)
        if modes.flat[0] == 1:
            out[:, 0] = out[:, 0].cumsum(axis=0, dtype=np.uint8)
            return out.cumsum(axis=1, dtype=np.uint8)
        out[0] = out[0].cumsum(axis=0, dtype=np.uint8)
        return out.cumsum(axis=0, dtype=np.uint8)
    if forward:
        source, out = image.astype(int), np.empty_like(image)
    else:
        source = out = image.astype(int)
    sign = -1 if forward else 1
    for y in range(h):
        for x in range(w):
            if not y and not x:
                p = np.array([255, 0, 0, 0])
            elif not y:
                p = source[0, x - 1]
            elif not x:
                p = source[y - 1, 0]
            else:
                right = source[y - 1, x + 1] if x + 1 < w else source[y, 0]
                p = predict(int(modes[y >> bits, x >> bits]) % 16 if modes[y >> bits, x >> bits] < 14 else 0, source[y, x - 1], source[y - 1, x], right, source[y - 1, x - 1])
            out[y, x] = (image[y, x].astype(int) + sign * p) & 255
    return out.astype(np.uint8)


def crossed(image: np.ndarray, factors: np.ndarray, forward: bool) -> np.ndarray:
    """factors, of each pixel or of all: A, R (red to blue), G (green to blue), B (green to red)."""
    signed = lambda c: c.astype(np.uint8).view(np.int8).astype(np.int16)
    f = np.ascontiguousarray(factors).view(np.int8).astype(np.int16)
    green, red, blue = signed(image[..., 2]), image[..., 1].astype(np.int16), image[..., 3].astype(np.int16)
    sign = -1 if forward else 1
    turned_red = (red + sign * (f[..., 3] * green >> 5)) & 255
    before = red if forward else turned_red
    blue = blue + sign * (f[..., 2] * green >> 5) + sign * (f[..., 1] * signed(before) >> 5)
    out = image.copy()
    out[..., 1], out[..., 3] = turned_red, blue & 255
    return out


def cross_colour(image: np.ndarray, factors: np.ndarray, bits: int, forward: bool) -> np.ndarray:
    """factors: by block."""
    h, w, _ = image.shape
    return crossed(image, np.repeat(np.repeat(factors, 1 << bits, 0), 1 << bits, 1)[:h, :w], forward)


def green_added(image: np.ndarray, sign: int) -> np.ndarray:
    out = image.astype(int)
    out[..., [1, 3]] += sign * out[..., [2]]
    return (out & 255).astype(np.uint8)


def pack_bits(colours: int) -> int:
    return 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0


def unpacked(image: np.ndarray, palette: np.ndarray, width: int) -> np.ndarray:
    bits = pack_bits(len(palette))
    per = 8 >> bits
    x = np.arange(width)
    index = (image[:, x >> bits, 2] >> (per * (x & ((1 << bits) - 1)))) & ((1 << per) - 1)
    table = np.zeros((256, 4), np.uint8)
    table[: len(palette)] = palette
    return table[index]


def chunk(data: bytes) -> bytes:
    """The VP8L chunk's content of a RIFF file."""
    if data[:4] != b"RIFF" or data[8:16] != b"WEBPVP8L":
        raise ValueError("not a lossless WebP file")
    (n,) = struct.unpack_from("<I", data, 16)
    if len(data) < 20 + n or data[20] != 0x2F:
        raise ValueError("VP8L chunk")
    return data[20 : 20 + n]


def riff(content: bytes) -> bytes:
    padded = content + b"\0" * (len(content) % 2)
    return b"RIFF" + struct.pack("<I", 12 + len(padded)) + b"WEBPVP8L" + struct.pack("<I", len(content)) + padded


def files(data: bytes) -> list[bytes]:
    """The files that lie one after another."""
    out, at = [], 0
    while at < len(data):
        (n,) = struct.unpack_from("<I", data, at + 4)
        out.append(data[at : at + 8 + n])
        at += 8 + n
    return out


def decode(data: bytes) -> np.ndarray:
    r = Reader(chunk(data))
    r.read(8)
    width, height = r.read(14) + 1, r.read(14) + 1
    used_alpha, version = r.read(1), r.read(3)
    if version:
        raise ValueError("VP8L version")
    now, undo = width, []
    while r.read(1):
        kind = r.read(2)
        if kind in (PREDICTOR, CROSS_COLOUR):
            bits = r.read(3) + 2
            w, h = cells(now, bits), cells(height, bits)
            undo.append((kind, bits, as_array(read_image(r, w, h, False), w, h), now))
        elif kind == PALETTE:
            n = r.read(8) + 1
            colours = as_array(read_image(r, n, 1, False), n, 1)[0].cumsum(axis=0, dtype=np.uint8)
            undo.append((kind, 0, colours, now))
            now = cells(now, pack_bits(n))
        else:
            undo.append((kind, 0, None, now))
    image = as_array(read_image(r, now, height, True), now, height)
    for kind, bits, extra, w in reversed(undo):
        if kind == PREDICTOR:
            image = predictor(image, extra[..., 2] & 15, bits, False)
        elif kind == CROSS_COLOUR:
            image = cross_colour(image, extra, bits, False)
        elif kind == SUBTRACT_GREEN:
            image = green_added(image, 1)
        else:
            image = unpacked(image, extra, w)
    return image


def depths(weights: list[int], most: int) -> list[int]:
    """Huffman code lengths of at most ``most`` for two or more ascending weights: two queues, of symbols and of joined nodes."""
    floor, n = 1, len(weights)
    while True:
        weight = weights if floor == 1 else [max(x, floor) for x in weights]
        weight = [*weight, *[0] * (n - 1)]
        parent = [0] * (2 * n - 1)
        leaf, node = 0, n
        for new in range(n, 2 * n - 1):
            if node < new and (leaf >= n or weight[node] < weight[leaf]):
                a = node
                node += 1
            else:
                a = leaf
                leaf += 1
            if node < new and (leaf >= n or weight[node] < weight[leaf]):
                b = node
                node += 1
            else:
                b = leaf
                leaf += 1
            weight[new] = weight[a] + weight[b]
            parent[a] = parent[b] = new
        depth = [0] * (2 * n - 1)
        for k in range(2 * n - 3, -1, -1):
            depth[k] = depth[parent[k]] + 1
        if max(depth[:n]) <= most:
            return depth[:n]
        floor *= 2


def code_lengths(counts: np.ndarray, most: int) -> list[int]:
    """Huffman code lengths of at most ``most`` by symbol; 0 for those without a count."""
    lengths = [0] * len(counts)
    used = np.flatnonzero(counts)
    order = used[np.argsort(counts[used], kind="stable")]
    for s, d in zip(order.tolist(), depths(counts[order].tolist(), most) if len(used) > 1 else [1]):
        lengths[s] = d
    return lengths


def _codes(counts: np.ndarray, most: int) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
    """(symbols, their lengths, all lengths as a matrix with zeros for codes of one symbol) of the code of each row."""
    row, symbol = np.nonzero(counts)
    weight = counts[row, symbol]
    first = np.searchsorted(row, np.arange(len(counts) + 1)).tolist()
    order = np.lexsort((symbol, weight, row))
    symbols, ordered, weights = symbol.tolist(), symbol[order].tolist(), weight[order].tolist()
    names, lengths = [], []
    matrix = np.zeros(counts.shape, np.int64)
    flat = np.zeros(len(row), np.int64)
    for a, b in zip(first, first[1:]):
        names.append(symbols[a:b])
        own = dict(zip(ordered[a:b], depths(weights[a:b], most))) if b - a > 1 else {}
        lengths.append([own[s] for s in symbols[a:b]] if own else [1] * (b - a))
        if own:
            flat[a:b] = lengths[-1]
    matrix[row, symbol] = flat
    return names, lengths, matrix


def write_prefix(w: Writer, lengths: list[int]) -> None:
    used = [s for s, n in enumerate(lengths) if n]
    if len(used) <= 1 and (not used or used[0] < 256):
        s = used[0] if used else 0
        w.write(1, 1)
        w.write(0, 1)
        w.write(int(s > 1), 1)
        w.write(s, 8 if s > 1 else 1)
        return
    last = used[-1] + 1
    runs, k = [], 0
    while k < last:
        n = 1
        while k + n < last and lengths[k + n] == lengths[k]:
            n += 1
        k += n
        if lengths[k - 1] == 0:
            while n >= 3:
                m = min(n, 138)
                runs.append((18, m - 11, 7) if m >= 11 else (17, m - 3, 3))
                n -= m
            runs += [(0, 0, 0)] * n
        else:
            runs.append((lengths[k - 1], 0, 0))
            n -= 1
            while n >= 3:
                m = min(n, 6)
                runs.append((16, m - 3, 2))
                n -= m
            runs += [(lengths[k - 1], 0, 0)] * n
    own = code_lengths(np.bincount([s for s, _, _ in runs], minlength=19), 7)
    stored = max(4, 1 + max(i for i, s in enumerate(LENGTH_ORDER) if own[s]))
    w.write(0, 1)
    w.write(stored - 4, 4)
    for s in LENGTH_ORDER[:stored]:
        w.write(own[s], 3)
    whole = len(runs) < 2
    w.write(int(not whole), 1)
    if not whole:
        n = len(runs) - 2
        half = max(0, -(-(max(1, n.bit_length()) - 2) // 2))
        w.write(half, 3)
        w.write(n, 2 + 2 * half)
    codes = canonical(own)
    single = sum(map(bool, own)) == 1
    for s, extra, bits in runs:
        if not single:
            w.write(codes[s], own[s])
        w.write(extra, bits)


#: Lengths of the code in which encode_many writes its codes' lengths: one for all images, so that it's made only once.
CODE_OF_LENGTHS = {0: 3, 1: 6, 2: 6, 3: 4, 4: 3, 5: 4, 6: 3, 7: 4, 8: 5, 9: 4, 10: 4, 11: 5, 12: 6, 16: 6, 17: 4, 18: 3}


def _fixed_code() -> tuple[tuple[int, int], list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(bits that begin a prefix code, what a gap of so many unused symbols takes and its steps, what each length takes)."""
    own = [CODE_OF_LENGTHS.get(s, 0) for s in range(19)]
    codes = canonical(own)
    w = Writer()
    stored = 1 + max(i for i, s in enumerate(LENGTH_ORDER) if own[s])
    w.write(0, 1)
    w.write(stored - 4, 4)
    for s in LENGTH_ORDER[:stored]:
        w.write(own[s], 3)
    bits = 8 * len(w.out) + w.at
    gaps = []
    for gap in range(256 + LENGTH_CODES):
        value = at = steps = 0
        while gap:
            m = 1 if gap < 3 else min(gap, 10) if gap < 11 else min(gap, 138)
            s, extra = (0, 0) if m < 3 else (17, 3) if m < 11 else (18, 7)
            value |= (codes[s] | (m - (3 if s == 17 else 11 if s == 18 else 1)) << own[s]) << at
            at += own[s] + extra
            steps += 1
            gap -= m
        gaps.append((value, at, steps))
    return (int.from_bytes(w.done(), "little"), bits), gaps, list(zip(codes, own))


def fixed_prefix(w: Writer, symbols: list[int], lengths: list[int]) -> None:
    """Writes a prefix code of symbols (ascending) and their lengths of at most 12, by CODE_OF_LENGTHS."""
    if len(symbols) < 2:
        s = symbols[0] if symbols else 0
        w.write(1 | int(s > 1) << 2 | s << 3, 11 if s > 1 else 4)
        return
    (value, at), gaps, codes = _FIXED
    body = bits = 0
    steps, last = len(symbols), -1
    for s, n in zip(symbols, lengths):
        if gap := s - last - 1:
            v, m, k = gaps[gap]
            body |= v << bits
            bits += m
            steps += k
        v, m = codes[n]
        body |= v << bits
        bits += m
        last = s
    half = max(0, -(-((steps - 2).bit_length() - 2) // 2))
    value |= (1 | half << 1 | (steps - 2) << 4) << at
    at += 6 + 2 * half
    w.write(value | body << at, at + bits)


def amount_code(v: int) -> tuple[int, int, int]:
    """(prefix code, extra value, extra bits) of v >= 1."""
    if v <= 4:
        return v - 1, 0, 0
    v -= 1
    top = v.bit_length() - 1
    return 2 * top + ((v >> top - 1) & 1), v & ((1 << top - 1) - 1), top - 1


def write_image(w: Writer, image: np.ndarray, main: bool, cache_bits: int = 0, references: bool = False) -> None:
    height, width, _ = image.shape
    pixels = image.reshape(-1, 4).copy().view(">u4").ravel().tolist()
    cache: list[int | None] = [None] * (1 << cache_bits) if cache_bits else []
    steps, seen, k = [], {}, 0
    while k < len(pixels):
        n, d = 0, 0
        if references and k + 3 <= len(pixels):
            j = seen.get(tuple(pixels[k : k + 3]))
            if j is not None:
                d = k - j
                while n < 4096 and k + n < len(pixels) and pixels[j + n] == pixels[k + n]:
                    n += 1
        if n >= 3:
            near = next((i for i, (x, y) in enumerate(NEAR) if max(1, x + y * width) == d), None)
            steps.append(("copy", n, near + 1 if near is not None else d + len(NEAR)))
        else:
            n = 1
            p = pixels[k]
            at = (CACHE_MULTIPLIER * p & 0xFFFFFFFF) >> 32 - cache_bits if cache else 0
            steps.append(("cache", at, 0) if cache and cache[at] == p else ("pixel", p, 0))
        for i in range(k, k + n):
            if references:
                seen[tuple(pixels[i : i + 3])] = i
            if cache:
                cache[(CACHE_MULTIPLIER * pixels[i] & 0xFFFFFFFF) >> 32 - cache_bits] = pixels[i]
        k += n
    w.write(int(bool(cache)), 1)
    if cache:
        w.write(cache_bits, 4)
    if main:
        w.write(0, 1)
    counts = [Counter() for _ in range(5)]
    for kind, a, b in steps:
        if kind == "pixel":
            for c, v in zip(counts, (a >> 8 & 255, a >> 16 & 255, a & 255, a >> 24)):
                c[v] += 1
        elif kind == "cache":
            counts[0][256 + LENGTH_CODES + a] += 1
        else:
            counts[0][256 + amount_code(a)[0]] += 1
            counts[4][amount_code(b)[0]] += 1
    sizes = (256 + LENGTH_CODES + len(cache), 256, 256, 256, DISTANCE_CODES)
    lengths = [code_lengths(np.array([c[k] for k in range(n)]), 15) for c, n in zip(counts, sizes)]
    for x in lengths:
        write_prefix(w, x)
    codes = [canonical(x) for x in lengths]
    many = [sum(map(bool, x)) > 1 for x in lengths]

    def put(i: int, s: int) -> None:
        if many[i]:
            w.write(codes[i][s], lengths[i][s])

    for kind, a, b in steps:
        if kind == "pixel":
            for i, v in enumerate((a >> 8 & 255, a >> 16 & 255, a & 255, a >> 24)):
                put(i, v)
        elif kind == "cache":
            put(0, 256 + LENGTH_CODES + a)
        else:
            for i, v in ((0, a), (4, b)):
                code, extra, bits = amount_code(v)
                put(i, code + (256 if i == 0 else 0))
                w.write(extra, bits)


def header(w: Writer, width: int, height: int, alpha: bool) -> None:
    if not (0 < width <= MAX_SIDE and 0 < height <= MAX_SIDE):
        raise ValueError("image size")
    w.write(0x2F, 8)
    w.write(width - 1, 14)
    w.write(height - 1, 14)
    w.write(int(alpha), 1)
    w.write(0, 3)


def encode(image: np.ndarray, predictor_modes: np.ndarray | None = None, factors: np.ndarray | None = None, bits: int = 2, subtract_green: bool = False, palette: bool = False, cache_bits: int = 0, references: bool = True) -> bytes:
    """modes and factors: by block of 2**bits pixels a side."""
    h, w_, _ = image.shape
    w = Writer()
    header(w, w_, h, bool((image[..., 0] != 255).any()))
    if palette:
        colours, index = np.unique(image.reshape(-1, 4), axis=0, return_inverse=True)
        if len(colours) > 256:
            raise ValueError("too many colours for a palette")
        w.write(1, 1)
        w.write(PALETTE, 2)
        w.write(len(colours) - 1, 8)
        write_image(w, np.diff(colours.astype(int), axis=0, prepend=np.zeros((1, 4), int)).astype(np.uint8)[None], False)
        b = pack_bits(len(colours))
        per, grid = 8 >> b, index.reshape(h, w_)
        packed = np.zeros((h, cells(w_, b), 4), np.uint8)
        packed[..., 0] = 255
        for x in range(w_):
            packed[:, x >> b, 2] |= (grid[:, x] << per * (x & ((1 << b) - 1))).astype(np.uint8)
        image = packed
    if subtract_green:
        w.write(1, 1)
        w.write(SUBTRACT_GREEN, 2)
        image = green_added(image, -1)
    if predictor_modes is not None:
        w.write(1, 1)
        w.write(PREDICTOR, 2)
        w.write(bits - 2, 3)
        grid = np.zeros((*predictor_modes.shape, 4), np.uint8)
        grid[..., 0], grid[..., 2] = 255, predictor_modes
        write_image(w, grid, False)
        image = predictor(image, predictor_modes, bits, True)
    if factors is not None:
        w.write(1, 1)
        w.write(CROSS_COLOUR, 2)
        w.write(bits - 2, 3)
        write_image(w, factors, False)
        image = cross_colour(image, factors, bits, True)
    w.write(0, 1)
    write_image(w, image, True, cache_bits, references)
    return riff(w.done())


_FIXED = _fixed_code()
_FIXED_TABLE = Prefix([CODE_OF_LENGTHS.get(s, 0) for s in range(19)])
#: Longest code of the fast lane for literals and lengths, and for distances; tables have 2**bits entries.
FAST_BITS, FAST_DISTANCE_BITS = 12, 8
#: Width of the images of encode_many, and their greatest height: so many pixels let references reach far, and images of a
#: batch are decoded side by side.
ROW, MAX_ROWS = 64, 128
#: Shortest reference that encode_many makes, and the longest of the format.
SHORTEST, LONGEST = 6, 4096
#: The factors that take green off red and blue whole, for one block that covers an image of any size here.
BLOCK_BITS = 9
GREY_FACTORS = np.array([[[255, 0, 32, 32]]], np.uint8)
CACHE_BITS = 4


class Bits:
    """Like Writer, in one number: for short pieces."""

    def __init__(self) -> None:
        self.value, self.at = 0, 0

    def write(self, v: int, n: int) -> None:
        self.value |= v << self.at
        self.at += n


def _single_block(kind: int, pixel: np.ndarray) -> tuple[int, int]:
    """The bits of a transform with one block."""
    w = Bits()
    w.write(1, 1)
    w.write(kind, 2)
    w.write(BLOCK_BITS - 2, 3)
    write_image(w, pixel, False)
    return w.value, w.at


_CROSS = _single_block(CROSS_COLOUR, GREY_FACTORS)
#: Whole-image predictors that encode_many tries: the pixel to the left, and the one above.
_PREDICT = {mode: _single_block(PREDICTOR, np.array([[[255, 0, mode, 0]]], np.uint8)) for mode in (1, 2)}
_AMOUNT_BITS = np.array([0, 0, 0, 0, *((k - 2) >> 1 for k in range(4, DISTANCE_CODES))])
_AMOUNT_BASE = np.array([1, 2, 3, 4, *((2 + (k & 1) << ((k - 2) >> 1)) + 1 for k in range(4, DISTANCE_CODES))])


def amount_codes(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(prefix code, extra value, extra bits) of each v >= 1."""
    code = np.searchsorted(_AMOUNT_BASE, v, side="right") - 1
    return code, v - _AMOUNT_BASE[code], _AMOUNT_BITS[code]


def _predicted(rows: np.ndarray, tops: np.ndarray, mode: int) -> np.ndarray:
    """What is left of samples, ROW a row, after the prediction by the left (mode 1) or upper one; tops: first rows of images."""
    out = rows.copy()
    if mode == 1:
        out[1:, 0] -= rows[:-1, 0]
        out[tops, 0] = rows[tops, 0]
        out[:, 1:] -= rows[:, :-1]
    else:
        out[1:] -= rows[:-1]
        out[tops] = rows[tops]
        out[tops, 1:] -= rows[tops, :-1]
    return out


def _entropies(values: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(bits of all values of each image at its own entropy, distinct values)."""
    counts = np.bincount(owner * 256 + values, minlength=256 * n).reshape(n, 256)
    total = counts.sum(axis=1)
    inner = np.zeros(n)
    for a in range(0, n, 1024):
        c = counts[a : a + 1024].astype(float)
        inner[a : a + 1024] = (c * np.log2(np.maximum(c, 1))).sum(axis=1)
    return total * np.log2(np.maximum(total, 1)) - inner, (counts > 0).sum(axis=1)


def _code_cost(symbols: np.ndarray) -> np.ndarray:
    """About so many bits a prefix code takes to store."""
    return np.where(symbols <= 1, 8, np.where(symbols == 2, 20, 50 + 4 * symbols))


DIRECT, GREEN_ONLY, LEFT, ABOVE, INDEXED, CACHED = range(6)


def chosen(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The transforms of each grey image, by the entropy of what they leave (references come after, whatever is chosen):

    DIRECT: none; GREEN_ONLY: cross-colour; LEFT, ABOVE: predictor and cross-colour; INDEXED: a palette of at most 16
    colours, which puts several pixels into one; CACHED: none, but the colour cache."""
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes)
    bits, colours = _entropies(flat, owner, n)
    cost = np.full((n, 6), np.inf)
    cost[:, DIRECT] = 3 * bits + 3 * _code_cost(colours)
    cost[:, GREEN_ONLY] = _CROSS[1] + bits + _code_cost(colours) + 16
    for choice, mode in ((LEFT, 1), (ABOVE, 2)):
        left, kinds = _entropies(_predicted(flat.reshape(-1, ROW), starts // ROW, mode).ravel(), owner, n)
        cost[:, choice] = _CROSS[1] + _PREDICT[mode][1] + left + _code_cost(kinds) + 16
    few = np.flatnonzero(colours <= 16)
    if len(few):
        cost[few, CACHED] = 5 + bits[few] + 3 * colours[few] * np.log2(1 + colours[few]) + _code_cost(2 * colours[few]) + 2 * _code_cost(colours[few])
        for k in few.tolist():
            own = flat[starts[k] : starts[k] + sizes[k]].reshape(-1, ROW)
            packed, _ = _indexed(own)
            left, kinds = _entropies(packed.ravel(), np.zeros(packed.size, np.int64), 1)
            cost[k, INDEXED] = 11 + 3 * _code_cost(colours[k]) + 3 * colours[k] * np.log2(1 + colours[k]) + left[0] + _code_cost(kinds)[0] + 16
    return cost.argmin(axis=1)


def _indexed(grey: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(green samples of the packed image, colours) of a grey image of at most 16 colours."""
    colours, index = np.unique(grey, return_inverse=True)
    index = index.reshape(grey.shape)
    bits = pack_bits(len(colours))
    per = 8 >> bits
    parts = index.reshape(len(grey), -1, 1 << bits).astype(np.uint8) << (per * np.arange(1 << bits)).astype(np.uint8)
    return np.bitwise_or.reduce(parts, axis=2), colours


def grey(samples: np.ndarray) -> np.ndarray:
    """Opaque pixels of these samples, (h, w, 4)."""
    out = np.repeat(samples[..., None], 4, axis=2)
    out[..., 0] = 255
    return out


def matches(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distance, length) at each place of the nearest earlier SHORTEST equal samples of the same image; distance 0: none."""
    n = len(flat)
    padded = np.concatenate((flat, np.zeros(8, np.uint8)))
    words = np.ndarray((n,), "<u8", padded, strides=(1,)) & np.uint64((1 << 8 * SHORTEST) - 1)
    first, last = np.repeat(starts.astype(np.int32), sizes), np.repeat((starts + sizes - SHORTEST).astype(np.int32), sizes)
    distance = np.zeros(n, np.int32)
    low = np.uint64((1 << 22) - 1)
    for a in range(0, n, 1 << 22):  # a place within a part takes 22 bits
        keys = words[a : a + (1 << 22)] * np.uint64(0x9E3779B97F4A7C15)
        keys &= ~low
        keys |= np.arange(len(keys), dtype=np.uint64)
        keys.sort()
        same = np.flatnonzero((keys[1:] ^ keys[:-1]) <= low)
        here, before = (keys[same + 1] & low).astype(np.int32) + np.int32(a), (keys[same] & low).astype(np.int32) + np.int32(a)
        good = (before >= first[here]) & (here <= last[here])
        here, before = here[good], before[good]
        good = words[here] == words[before]
        distance[here[good]] = (here - before)[good]
    bounds = np.flatnonzero(np.append(distance[1:] != distance[:-1], True)).astype(np.int32)
    length = np.repeat(bounds + np.int32(SHORTEST), np.diff(bounds, prepend=-1)) - np.arange(n, dtype=np.int32)
    length[distance == 0] = 1
    return distance, np.minimum(length, LONGEST)


def _parsed(length: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where the steps of all images begin, if each takes the length at its place."""
    begins = np.zeros(len(length), bool)
    at, ends = starts.copy(), starts + sizes
    while len(at):
        begins[at] = True
        at = at + length[at]
        if (at >= ends).any():
            open_ = at < ends
            at, ends = at[open_], ends[open_]
    return np.flatnonzero(begins)


def encode_many(payloads: list[bytes]) -> list[bytes]:
    """Grey opaque images of ROW pixels a row, the payloads' bytes their samples; at most MAX_ROWS rows."""
    flat = np.frombuffer(b"".join(payloads), np.uint8)
    sizes = np.fromiter(map(len, payloads), np.int64, len(payloads))
    if not len(payloads):
        return []
    starts = np.cumsum(sizes) - sizes
    choice = chosen(flat, starts, sizes)
    out: list[bytes | None] = [None] * len(payloads)
    heads, planes, kept = [], [], []
    for k, c in enumerate(choice.tolist()):
        own = flat[starts[k] : starts[k] + sizes[k]].reshape(-1, ROW)
        if c == CACHED or c == DIRECT and own.min() != own.max():
            out[k] = encode(grey(own), cache_bits=CACHE_BITS if c == CACHED else 0)
            continue
        w = Bits()
        header(w, ROW, len(own), False)
        plane = own
        if c == INDEXED:
            plane, colours = _indexed(own)
            w.write(1 | PALETTE << 1, 3)
            w.write(len(colours) - 1, 8)
            deltas = grey(np.diff(colours, prepend=np.uint8(0)).astype(np.uint8)[None])
            deltas[0, 1:, 0] = 0
            write_image(w, deltas, False)
        elif c in (LEFT, ABOVE):
            mode = 1 if c == LEFT else 2
            plane = _predicted(own, np.zeros(1, np.int64), mode)
            w.write(*_PREDICT[mode])
        if c in (GREEN_ONLY, LEFT, ABOVE):
            w.write(*_CROSS)
        w.write(0, 3)  # no more transforms, no colour cache, one group
        # what is left of the other channels, and of alpha
        heads.append((w, int(own[0, 0]) if c == DIRECT else 0, 0 if c in (LEFT, ABOVE) else 255))
        planes.append(plane.ravel())
        kept.append(k)
    if kept:
        for k, made in zip(kept, _written(planes, heads)):
            out[k] = made
    return out


def _written(planes: list[np.ndarray], heads: list[tuple[Bits, int, int]]) -> list[bytes]:
    """The files of images whose other channels are one sample throughout; heads: the bits so far, that of red and blue, that
    of alpha."""
    n = len(planes)
    sizes = np.fromiter(map(len, planes), np.int64, n)
    flat, starts = np.concatenate(planes), np.cumsum(sizes) - sizes
    distance, length = matches(flat, starts, sizes)
    at = _parsed(length, starts, sizes)
    owner = np.searchsorted(starts, at, side="right") - 1
    symbol = flat[at].astype(np.int64)
    copies = np.flatnonzero(distance[at])
    code, extra, extra_bits = amount_codes(length[at[copies]])
    far, far_extra, far_bits = amount_codes(distance[at[copies]] + len(NEAR))
    symbol[copies] = 256 + code
    alphabet = 256 + LENGTH_CODES
    counts = np.bincount(owner * alphabet + symbol, minlength=alphabet * n).reshape(n, alphabet)
    far_counts = np.bincount(owner[copies] * DISTANCE_CODES + far, minlength=DISTANCE_CODES * n).reshape(n, DISTANCE_CODES)
    near_symbols, near_lengths, lengths = _codes(counts, FAST_BITS)
    far_symbols, far_own, far_lengths = _codes(far_counts, FAST_DISTANCE_BITS)
    codes, far_codes = canonical_many(lengths), canonical_many(far_lengths)
    lead = []
    for k, (w, other, alpha) in enumerate(heads):
        fixed_prefix(w, near_symbols[k], near_lengths[k])
        for sample in (other, other, alpha):
            fixed_prefix(w, [sample], [1])
        fixed_prefix(w, far_symbols[k], far_own[k])
        lead.append(w.at)
    # a step is one piece of at most 22 bits, a reference's distance another one of at most 20
    pieces, bits = codes[owner, symbol], lengths[owner, symbol]
    pieces[copies] |= extra.astype(np.uint64) << bits[copies].astype(np.uint64)
    bits[copies] += extra_bits
    away = far_lengths[owner[copies], far]
    second = far_codes[owner[copies], far] | far_extra.astype(np.uint64) << away.astype(np.uint64)
    pieces, owner = np.insert(pieces, copies + 1, second), np.insert(owner, copies + 1, owner[copies])
    bits = np.insert(bits, copies + 1, away + far_bits)
    ends = np.cumsum(bits)
    first = np.searchsorted(owner, np.arange(n + 1))
    before = np.append(0, ends)[first]
    total = np.diff(before)
    lead = np.array(lead, np.int64)
    skip = lead >> 5 << 5  # whole words of the head are put in as they are
    words = (lead - skip + total + 31) // 32 + 1
    word_start = np.cumsum(words) - words
    where = ends - bits + (lead - skip + 32 * word_start - before[:-1])[owner]
    spread, w = pieces << (where & 31).astype(np.uint64), where >> 5
    out = np.zeros(int(words.sum()) + 1, np.uint64)
    new = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
    out[w[new]] |= np.bitwise_or.reduceat(spread & np.uint64(0xFFFFFFFF), new)
    out[w[new] + 1] |= np.bitwise_or.reduceat(spread >> np.uint64(32), new)
    out[word_start] |= np.array([h.value >> s for (h, *_), s in zip(heads, skip.tolist())], np.uint64)
    raw = out.astype("<u4").tobytes()
    made = []
    for (h, *_), s, i, t, d in zip(heads, skip.tolist(), word_start.tolist(), total.tolist(), lead.tolist()):
        made.append(riff((h.value & (1 << s) - 1).to_bytes(s // 8, "little") + raw[4 * i : 4 * i + (d - s + t + 7) // 8]))
    return made


def _quick_prefix(value: int, at: int, alphabet: int) -> tuple[list[tuple[int, int]], int]:
    """((symbol, length) of a prefix code's symbols, the first bit after it) in a stream as one number."""
    if value >> at & 1:
        two, wide = value >> at + 1 & 1, value >> at + 2 & 1
        at += 3
        size = 8 if wide else 1
        symbols = [value >> at & (1 << size) - 1]
        at += size
        if two:
            symbols.append(value >> at & 255)
            at += 8
        return [(s, 1) for s in symbols], at
    bits, start = value >> at & (1 << 4096) - 1, at
    if bits & (1 << _FIXED[0][1]) - 1 == _FIXED[0][0]:
        at, bits, code = at + _FIXED[0][1], bits >> _FIXED[0][1], _FIXED_TABLE
    else:
        n = 4 + (bits >> 1 & 15)
        own = [0] * 19
        for k, s in enumerate(LENGTH_ORDER[:n]):
            own[s] = bits >> 5 + 3 * k & 7
        at, bits, code = at + 5 + 3 * n, bits >> 5 + 3 * n, Prefix(own)
    left = alphabet
    if bits & 1:
        m = 2 + 2 * (bits >> 1 & 7)
        left = 2 + (bits >> 4 & (1 << m) - 1)
        bits >>= 4 + m
        at += 4 + m
    else:
        bits >>= 1
        at += 1
    table = code.table if code.bits else [(code.only, 0)]
    found, place, last, mask = [], 0, 8, len(table) - 1
    while place < alphabet and left:
        left -= 1
        s, m = table[bits & mask]
        bits >>= m
        at += m
        if s < 16:
            if s:
                found.append((place, s))
                last = s
            place += 1
            continue
        m = (2, 3, 7)[s - 16]
        run = (11 if s == 18 else 3) + (bits & (1 << m) - 1)
        bits >>= m
        at += m
        if place + run > alphabet:
            raise ValueError("code lengths run over")
        if s == 16:
            found += [(k, last) for k in range(place, place + run)]
        place += run
    if at - start > 4096:
        raise ValueError("a prefix code too long to be one")
    return found, at


@dataclass(frozen=True)
class Known:
    """What the fast lane needs of an image: sizes, transforms, the sample of the other channels, where the pixels begin, the
    codes of literals and lengths, and of distances."""

    width: int
    height: int
    across: int
    mode: int
    crossed: bool
    palette: np.ndarray | None
    other: int
    at: int
    near: list[tuple[int, int]]
    far: list[tuple[int, int]]


def _known(data: bytes) -> Known | None:
    """None where the fast lane doesn't apply."""
    head = int.from_bytes(data[:2048], "little")
    width, height = (head >> 8 & 0x3FFF) + 1, (head >> 22 & 0x3FFF) + 1
    if head >> 36 & 15 or width > 1 << BLOCK_BITS or height > 1 << BLOCK_BITS:
        return None
    at, across, mode, crossed, palette = 40, width, 0, False, None
    for m, (value, n) in _PREDICT.items():
        if head >> at & (1 << n) - 1 == value:
            at, mode = at + n, m
    if head >> at & (1 << _CROSS[1]) - 1 == _CROSS[0]:
        at, crossed = at + _CROSS[1], True
    if not (mode or crossed) and head >> at & 7 == 1 | PALETTE << 1:
        r = Reader(data)
        r.at = at + 3
        n = r.read(8) + 1
        palette = as_array(read_image(r, n, 1, False), n, 1)[0].cumsum(axis=0, dtype=np.uint8)
        at, across = r.at, cells(width, pack_bits(n))
    if head >> at & 7:  # another transform, a colour cache, several groups
        return None
    at += 3
    codes = []
    for alphabet in (256 + LENGTH_CODES, 256, 256, 256, DISTANCE_CODES):
        own, at = _quick_prefix(head, at, alphabet)
        codes.append(own)
    near, *rest, far = codes
    red, blue, alpha = (c[0][0] if len(c) == 1 else None for c in rest)
    longest = [max((n for _, n in c), default=0) for c in (near, far)]
    if red is None or red != blue or alpha != (0 if mode else 255) or longest[0] > FAST_BITS or longest[1] > FAST_DISTANCE_BITS or at > 8 * len(data):
        return None
    return Known(width, height, across, mode, crossed, palette, red, at, near, far)


def decode_many(images: list[bytes]) -> list[np.ndarray]:
    """Pixels (height, width, 3) in the order R, G, B of each image; those outside the fast lane one by one.

    The fast lane is for images of one group whose red, blue and alpha are one sample throughout as stored: then a literal is
    one code. It reads references and inverts cross-colour, predictor and palette transforms of all images of a batch."""
    content = [chunk(x) for x in images]
    known = [_known(c) for c in content]
    out: list[np.ndarray | None] = [None if f else decode(x)[..., 1:] for f, x in zip(known, images)]
    fast = sorted((k for k, f in enumerate(known) if f), key=lambda k: -len(content[k]))
    for a in range(0, len(fast), 2048):
        part = fast[a : a + 2048]
        for k, pixels in zip(part, _together([content[k] for k in part], [known[k] for k in part])):
            out[k] = pixels
    return out


def _tables(codes: list[list[tuple[int, int]]], bits: int) -> np.ndarray:
    """By image and next bits: symbol << 4 | length."""
    sizes = np.fromiter(map(len, codes), np.int64, len(codes))
    flat = np.array([x for own in codes for x in (own or [(0, 0)])], np.int64)
    image = np.repeat(np.arange(len(codes)), np.maximum(sizes, 1))
    symbol, n = flat[:, 0], np.where(sizes[image] < 2, 0, flat[:, 1])
    many = 1 << bits - n
    if (np.bincount(image, many, len(codes)) != 1 << bits).any():
        raise ValueError("not a whole prefix code")
    # codes in canonical order fill the table in the order of reversed bits
    order = np.lexsort((symbol, n, image))
    tables = np.repeat((symbol << 4 | n)[order].astype(np.uint16), many[order]).reshape(len(codes), -1)
    return tables[:, _reversed_index(bits)].ravel()


def _together(content: list[bytes], known: list[Known]) -> list[np.ndarray]:
    """The fast lane: all images advance together, a literal or reference a step."""
    n = len(known)
    literals, far = _tables([f.near for f in known], FAST_BITS), _tables([f.far for f in known], FAST_DISTANCE_BITS)
    buffer = b"".join(content) + b"\0" * 16
    sizes = np.fromiter(map(len, content), np.int64, n)
    begin = np.cumsum(sizes) - sizes
    at = 8 * begin + np.array([f.at for f in known])
    window = np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,))
    across = np.array([f.across for f in known])
    pixels = across * np.array([f.height for f in known])
    ends = np.cumsum(pixels)
    place = ends - pixels
    starts = place.copy()
    green = np.zeros(int(ends[-1]), np.uint8)
    image, stop = np.arange(n), ends
    references = []
    near_x, near_y = np.array(NEAR).T
    bound = np.uint64((1 << FAST_BITS) - 1), np.uint64((1 << FAST_DISTANCE_BITS) - 1)
    while len(image):
        bits = window[np.minimum(at >> 3, len(window) - 1)] >> (at & 7).astype(np.uint64)
        got = literals[(image << FAST_BITS) + (bits & bound[0]).astype(np.int64)]
        symbol, used = got >> 4, (got & 15).astype(np.int64)
        green[place] = symbol  # a reference's place is filled later
        at = at + used
        copies = np.flatnonzero(symbol >= 256)
        if len(copies):
            rest = bits[copies] >> used[copies].astype(np.uint64)
            code = symbol[copies].astype(np.int64) - 256
            extra = _AMOUNT_BITS[code]
            length = _AMOUNT_BASE[code] + (rest & ((np.uint64(1) << extra.astype(np.uint64)) - np.uint64(1))).astype(np.int64)
            rest >>= extra.astype(np.uint64)
            got = far[(image[copies] << FAST_DISTANCE_BITS) + (rest & bound[1]).astype(np.int64)]
            used = (got & 15).astype(np.int64)
            rest >>= used.astype(np.uint64)
            more = _AMOUNT_BITS[got >> 4]
            distance = _AMOUNT_BASE[got >> 4] + (rest & ((np.uint64(1) << more.astype(np.uint64)) - np.uint64(1))).astype(np.int64)
            at[copies] += extra + used + more
            close = distance <= len(NEAR)
            k = np.minimum(distance, len(NEAR)) - 1
            distance = np.where(close, np.maximum(1, near_x[k] + near_y[k] * across[image[copies]]), distance - len(NEAR))
            here = place[copies]
            if (here - distance < starts[image[copies]]).any() or (here + length > stop[copies]).any():
                raise ValueError("a back-reference leaves the image")
            references.append((here, length, distance))
            step = np.ones(len(image), np.int64)
            step[copies] = length
            place = place + step
        else:
            place = place + 1
        done = place >= stop
        if done.any():
            if (at[done] > 8 * (begin + sizes)[image[done]]).any():
                raise ValueError("the stream ends too early")
            image, place, stop, at = image[~done], place[~done], stop[~done], at[~done]
    if references:
        _copied(green, *(np.concatenate(x) for x in zip(*references)))
    return _undone(green, starts, ends, known)


def _copied(green: np.ndarray, place: np.ndarray, length: np.ndarray, distance: np.ndarray) -> None:
    """Fills in the references. Each pixel of one points to the pixel it's a copy of, which may be a copy again; pointers are
    doubled until all point to literals."""
    ends = np.cumsum(length)
    to = np.repeat(place - (ends - length), length) + np.arange(int(ends[-1]))
    source = np.arange(len(green), dtype=np.int32)
    source[to] = to - np.repeat(distance, length)
    open_ = to
    while len(open_):
        now = source[open_]
        then = source[now]
        source[open_] = then
        open_ = open_[then != now]
    green[to] = green[source[to]]


def _undone(green: np.ndarray, starts: np.ndarray, ends: np.ndarray, known: list[Known]) -> list[np.ndarray]:
    """R, G, B of each image from its stored green samples: the transforms are inverted, last first."""
    whole = np.empty((len(green), 4), np.uint8)
    whole[:, 0] = 255
    whole[:, 2] = green
    whole[:, [1, 3]] = np.repeat(np.array([f.other for f in known], np.uint8), ends - starts)[:, None]
    # all crossed images have the same factors, so they are one image here
    own = np.flatnonzero(np.repeat(np.array([f.crossed for f in known]), ends - starts))
    for a in range(0, len(own), 1 << 20):
        part = own[a : a + (1 << 20)]
        whole[part] = crossed(whole[part], GREY_FACTORS[0, 0], False)
    out = []
    for a, b, f in zip(starts, ends, known):
        image = whole[a:b].reshape(f.height, f.across, 4)
        if f.palette is not None:
            image = unpacked(image, f.palette, f.width)
        if f.mode:
            image = predictor(image, np.full((1, 1), f.mode), BLOCK_BITS, False)
        out.append(image[..., 1:])
    return out
