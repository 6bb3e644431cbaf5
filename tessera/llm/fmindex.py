"""A compressed FM-index over word numbers: wavelet-tree ranks and vectorised backward search.

The text is a row of numbers (words), cut into segments that end with a
separator.  Its transform is kept as a wavelet tree of packed bit vectors with
sampled counts; the suffix array itself is thrown away.
"""

from __future__ import annotations

import numpy as np

_BELOW = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


class Bits:
    """Bit vector packed in 64-bit words, with rank: ones before a position."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.packed = np.concatenate((packed, np.zeros(16 - len(packed) % 8, np.uint8))).view(np.uint64)
        ones = np.bitwise_count(self.packed)
        self.before = (np.cumsum(ones, dtype=np.int64) - ones).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        return self.before[word] + np.bitwise_count(self.packed[word] & _BELOW[at & 63])


class WaveletTree:
    """Ranks of numbers below ``1 << levels``, one bit vector a level (a wavelet matrix: zeros before ones)."""

    def __init__(self, values: np.ndarray, levels: int):
        self.levels, self.bits, self.zeros = levels, [], []
        top = int(values.max()) + 1 if len(values) else 1
        for level in range(levels - 1, -1, -1):
            bit = (values >> level) & 1
            self.bits.append(Bits(bit.astype(np.uint8)))
            self.zeros.append(int(len(values) - bit.sum()))
            values = np.concatenate((values[bit == 0], values[bit == 1]))
        # where each number's own run begins below the last level
        self.start = np.zeros(top, np.int32)
        self.start = self.path(np.arange(top, dtype=np.int32), self.start)

    def path(self, values: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Position below the last level that each value's path from a position leads to."""
        for level, (bits, zeros) in enumerate(zip(self.bits, self.zeros, strict=True)):
            one = (values >> (self.levels - 1 - level)) & 1
            ones = bits.rank(at)
            at = np.where(one, zeros + ones, at - ones)
        return at

    def rank(self, values: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each value stands before its position."""
        return self.path(values, at) - self.start[values]


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes by their first ``depth`` numbers at least, by prefix doubling."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    done = 1
    while True:
        ahead = np.concatenate((rank[done:] + 1, np.zeros(min(done, len(rank)), np.int64)))
        key = rank * (len(text) + 1) + ahead
        order = np.argsort(key, kind="stable")
        if done * 2 >= depth:
            return order
        step = np.concatenate(([0], (np.diff(key[order]) > 0).astype(np.int64)))
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(step)
        if rank[order[-1]] == len(text) - 1:
            return order
        done *= 2


class FMIndex:
    """Index of segments of numbers (1 and above; 0 separates), good for patterns of up to ``depth`` numbers."""

    def __init__(self, segments: list[np.ndarray], depth: int):
        self.depth = depth
        parts = [x for s in segments for x in (s, np.zeros(1, np.int64))]
        text = np.concatenate(parts) if parts else np.zeros(1, np.int64)
        top = int(text.max())
        # cyclic: the number before the first one is the last separator
        transform = text[suffix_order(text, depth + 1) - 1]
        self.tree = WaveletTree(transform, max(1, top.bit_length()))
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1)))).astype(np.int32)

    def matching_statistics(self, text: np.ndarray, ends: np.ndarray, least: int) -> np.ndarray:
        """Longest run of numbers ending at each end (at most ``depth``) that the index holds ``least`` times or more."""
        length = np.zeros(len(ends), np.int32)
        value = text[ends].astype(np.int32)
        low, high = self.first[value], self.first[value + 1]  # the last number alone
        active = np.flatnonzero((value > 0) & (high - low >= least))
        low, high = low[active], high[active]
        length[active] = 1
        for step in range(1, self.depth):
            at = ends[active] - step
            value = text[np.maximum(at, 0)].astype(np.int32)
            base = self.first[value]
            low, high = base + self.tree.rank(value, low), base + self.tree.rank(value, high)
            go = (at >= 0) & (value > 0) & (high - low >= least)
            active, low, high = active[go], low[go], high[go]
            if not len(active):
                break
            length[active] = step + 1
        return length
