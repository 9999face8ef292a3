"""Packed bitvectors with rank and select by a directory of block popcounts, many positions at once.

A bitvector lies in 64-bit words; the directory holds the number of ones before each block of ``BLOCK_WORDS`` words, so it
takes an eighth of the bits. rank(p) is the directory's entry, the popcounts of the block's words before p's, and a masked
popcount; select(k) finds its block in the directory by bisection, its word by popcounts, and its bit by halving the word.
"""

from __future__ import annotations

import numpy as np

BLOCK_WORDS = 8
_ONE = np.uint64(1)


class Bits:
    """Of an array of flags. Positions and ranks count from 0."""

    def __init__(self, flags: np.ndarray) -> None:
        self.size = len(flags)
        packed = np.packbits(flags, bitorder="little")
        # a word more than needed, so that the rank of the end needs no case of its own
        blocks = len(packed) // (8 * BLOCK_WORDS) + 1
        held = np.zeros(blocks * 8 * BLOCK_WORDS, np.uint8)
        held[: len(packed)] = packed
        self.words = held.view("<u8")
        self.directory = np.zeros(blocks + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words).reshape(blocks, BLOCK_WORDS).sum(1, dtype=np.int64), out=self.directory[1:])

    @property
    def total(self) -> int:
        return int(self.directory[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position, 0 <= at <= size."""
        at = np.asarray(at, np.int64)
        word = at >> 6
        block = word // BLOCK_WORDS
        out = self.directory[block]
        for k in range(BLOCK_WORDS - 1):
            own = block * BLOCK_WORDS + k
            out = out + np.where(own < word, np.bitwise_count(self.words[own]), 0)
        below = (_ONE << (at & 63).astype(np.uint64)) - _ONE
        return out + np.bitwise_count(self.words[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The position of the one of each rank, 0 <= k <= total; of rank ``total``: the size."""
        k = np.asarray(k, np.int64)
        end = k >= self.total
        asked = np.where(end, 0, k)
        block = np.searchsorted(self.directory, asked, side="right") - 1
        if not self.total:
            return np.full(k.shape, self.size, np.int64)
        left, word = asked - self.directory[block], block * BLOCK_WORDS
        for _ in range(BLOCK_WORDS - 1):
            ones = np.bitwise_count(self.words[word]).astype(np.int64)
            on = left >= ones
            # once the word is found, its count stays above what is left
            left, word = np.where(on, left - ones, left), word + on
        bits, at = self.words[word], word << 6
        for width in (32, 16, 8, 4, 2, 1):
            low = bits & ((_ONE << np.uint64(width)) - _ONE)
            ones = np.bitwise_count(low).astype(np.int64)
            on = left >= ones
            left, at = np.where(on, left - ones, left), at + width * on
            bits = np.where(on, bits >> np.uint64(width), low)
        return np.where(end, self.size, at)


def starts_of_points(data: np.ndarray) -> np.ndarray:
    """Flags of the bytes of UTF-8 with which code points begin."""
    return (data & 0xC0) != 0x80
