"""A compressed FM-index over many short sequences, in numpy.

The sequences are concatenated, each closed by its own sentinel; the Burrows-Wheeler
transform sits in a wavelet matrix (one packed bit vector per bit of the alphabet, with
block counts for rank).  Patterns are searched backwards, all at once: one symbol per
step extends every pattern's suffix interval.  Intervals of a fixed length are kept by
moving to the parent interval (from block boundaries of the suffix order) before a step.
"""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """rank of a symbol in a prefix, for arrays of (symbol, position)."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        now = values
        for b in range(bits - 1, -1, -1):
            bit = (now >> b & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            blocks = np.zeros(len(values) // 64 + 2, np.uint64)
            blocks.view(np.uint8)[:len(packed)] = packed
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(blocks))[:-1]])
            self.levels.append((b, blocks, before.astype(np.int32), int((~bit).sum())))
            now = np.concatenate([now[~bit], now[bit]])
        self.start = self._walk(np.arange(1 << bits), np.zeros(1 << bits, np.int64))

    def _walk(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for b, blocks, before, zeros in self.levels:
            at = i >> 6
            low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[at] + np.bitwise_count(blocks[at] & low)
            i = np.where(symbol >> b & 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self._walk(symbol, i) - self.start[symbol]


class FMIndex:
    """Index of sequences of hashed words; ``flat`` holds them one after another."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray, span: int):
        self.span, self.lengths = span, lengths
        count = len(lengths)
        self.alphabet, symbol = np.unique(flat, return_inverse=True)
        n = len(flat) + count
        self.first = np.cumsum(lengths + 1) - lengths - 1  # of each sequence, in the text
        self.text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[self.first + lengths] = False
        self.text[inside] = symbol + 1
        rank = np.empty(n, np.int64)
        rank[inside] = count + symbol
        rank[~inside] = np.arange(count)
        ranks, width = {1: rank}, 1
        while True:  # prefix doubling; sentinels differ, so it ends at the longest sequence
            ahead = np.zeros(n, np.int64)
            ahead[:n - width] = rank[width:] + 1
            key = rank * (n + 1) + ahead
            order = np.argsort(key, kind="stable")
            step = np.concatenate([[0], np.diff(key[order]) > 0])
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(step)
            width *= 2
            ranks[width] = rank
            if rank.max(initial=0) == n - 1 and width >= span:
                break
        self.order = order
        self.symbols_before = np.concatenate(
            [[0], np.cumsum(np.bincount(self.text, minlength=len(self.alphabet) + 1))])
        self.wavelet = WaveletMatrix(self.text[order - 1],
                                     max(1, int(len(self.alphabet)).bit_length()))
        self.blocks = {d: self._blocks(ranks, d) for d in (span - 1, span)}

    def _blocks(self, ranks: dict, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(block of each suffix, first suffix of each block), equal to ``depth``."""
        n, new, at = len(self.order), np.zeros(len(self.order), bool), 0
        new[:1] = True
        width = max(ranks)
        while depth:
            while width > depth:
                width //= 2
            padded = np.concatenate([ranks[width], np.full(at + 1, -1)])
            new[1:] |= np.diff(padded[self.order + at]) != 0
            at, depth = at + width, depth - width
        return np.cumsum(new) - 1, np.append(np.flatnonzero(new), n)

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        """Extend patterns one symbol to the left."""
        base = self.symbols_before[symbol]
        return base + self.wavelet.rank(symbol, lo), base + self.wavelet.rank(symbol, hi)

    def count(self, pattern: np.ndarray) -> int:
        """Occurrences of one pattern of words."""
        lo, hi = np.zeros(1, np.int64), np.full(1, len(self.order))
        for w in pattern[::-1]:
            at = np.searchsorted(self.alphabet, w)
            if at == len(self.alphabet) or self.alphabet[at] != w:
                return 0
            lo, hi = self.step(np.array([at + 1]), lo, hi)
        return int((hi - lo)[0])

    def matches(self, smallest_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Stream the indexed sequences: for every window of ``span`` words
        (sequence, offset, smallest ``smallest_of`` over the sequences it occurs in)."""
        sequence_at = np.repeat(np.arange(len(self.lengths)), self.lengths + 1)
        block, first = self.blocks[self.span]
        least = np.minimum.reduceat(smallest_of[sequence_at[self.order]], first[:-1])
        parent, parent_first = self.blocks[self.span - 1]
        longest_first = np.argsort(-self.lengths, kind="stable")
        size = self.lengths[longest_first]
        end = self.first[longest_first] + size
        lo, hi = np.zeros(len(size), np.int64), np.full(len(size), len(self.order))
        out = []
        for s in range(int(size[0]) if len(size) else 0):
            a = np.searchsorted(-size, -s, "left")  # sequences longer than s
            lo, hi = lo[:a], hi[:a]
            if s >= self.span:
                lo, hi = parent_first[parent[lo]], parent_first[parent[lo] + 1]
            lo, hi = self.step(self.text[end[:a] - 1 - s], lo, hi)
            if s >= self.span - 1:
                out.append((longest_first[:a], size[:a] - 1 - s, least[block[lo]]))
        if not out:
            return tuple(np.empty(0, np.int64) for _ in range(3))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))
