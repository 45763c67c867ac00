"""A compressed full-text index of integer sequences: BWT in a wavelet tree, backward search in bulk."""

from __future__ import annotations

import numpy as np

#: Bits of a symbol that one level of the tree tells apart: each node has 8 children.
FAN_BITS = 3
FAN = 1 << FAN_BITS


class WaveletTree:
    """Counts of a symbol before a position, over a sequence of symbols below 2**bits.

    Level by level the sequence is ordered by the leading digits read so far
    (a node is a range of it). Each level holds one bit per position and digit,
    in words of 64, and the digit's count before each word.
    """

    def __init__(self, symbols: np.ndarray, bits: int):
        self.n, self.levels = len(symbols), max(1, -(-bits // FAN_BITS))
        self.masks, self.counts, self.begin = [], [], []
        row = symbols.astype(np.uint32)
        blocks = self.n // 64 + 1
        for level in range(self.levels):
            shift = np.uint32(FAN_BITS * (self.levels - 1 - level))
            digit = (row >> shift & np.uint32(FAN - 1)).astype(np.uint8)
            padded = np.full(blocks * 64, 255, dtype=np.uint8)
            padded[: self.n] = digit
            masks = np.stack([np.packbits((padded == d).reshape(blocks, 64), axis=1, bitorder="little").view("<u8").ravel() for d in range(FAN)], axis=1)
            counts = np.zeros((blocks, FAN), dtype=np.int32)
            np.cumsum(np.bitwise_count(masks[:-1]), axis=0, out=counts[1:])
            self.masks.append(masks.ravel())
            self.counts.append(counts.ravel())
            # all of digit 0 first, then 1, ...: a node's children stay together in each digit's part
            totals = np.bincount(digit, minlength=FAN)
            self.begin.append((np.cumsum(totals) - totals).astype(np.int64))
            row = row[np.argsort(digit, kind="stable")]
        # where each symbol's own part begins in the last order
        every = np.arange(1 << bits, dtype=np.int64)
        self.start = self._down(every, np.zeros(len(every), dtype=np.int64))

    def _before(self, level: int, digit: np.ndarray, at: np.ndarray) -> np.ndarray:
        slot = (at >> 6) * FAN + digit
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[level][slot] + np.bitwise_count(self.masks[level][slot] & low)

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level in range(self.levels):
            digit = (symbol >> (FAN_BITS * (self.levels - 1 - level))) & (FAN - 1)
            at = self.begin[level][digit] + self._before(level, digit, at)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its position."""
        return self._down(symbol, at) - self.start[symbol]


class FMIndex:
    """Backward search of patterns of up to ``depth`` symbols over a text of positive symbols; 0 separates.

    Suffixes are ordered by their first ``depth`` symbols at least (prefix
    doubling), which is all that intervals of such patterns depend on. The
    suffix order itself is kept only to say where an interval's matches lie.
    """

    def __init__(self, text: np.ndarray, depth: int):
        # a separator at the end, so that no match runs on at the front
        values, codes = np.unique(np.concatenate([text.astype(np.uint64), np.zeros(1, dtype=np.uint64)]), return_inverse=True)
        self.n, self.values, codes = len(codes), values, codes.astype(np.int64)
        bits = max(1, int(len(values) - 1).bit_length())
        # as many symbols as fit one word are compared at once, then twice as many each time
        key, reach = codes.astype(np.uint64), max(1, min(depth, 64 // bits))
        for k in range(1, reach):
            key = key << np.uint64(bits)
            key[: self.n - k] |= codes[k:].astype(np.uint64) if k < self.n else np.uint64(0)
        while True:
            order = np.argsort(key)
            ranked = key[order]
            if reach >= depth:
                break
            rank = np.empty(self.n, dtype=np.int64)
            rank[order] = np.cumsum(np.r_[0, ranked[1:] != ranked[:-1]])
            ahead = np.zeros(self.n, dtype=np.int64)
            ahead[: max(0, self.n - reach)] = rank[reach:] + 1
            key = rank * (self.n + 2) + ahead
            reach *= 2
        self.order = order.astype(np.int32 if self.n < 1 << 31 else np.int64)
        self.codes = codes
        counts = np.bincount(codes, minlength=len(values))
        self.first = np.cumsum(counts) - counts
        self.total = counts
        self.tree = WaveletTree(codes[order - 1], bits)

    def matches(self, at: np.ndarray, length: int, alone: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the windows of ``length`` symbols that start at positions ``at`` of the text.

        With ``alone`` a window is given up (left = right) as soon as its last
        symbols occur nowhere else.
        """
        last = self.codes[at + length - 1]
        left = self.first[last].copy()
        right = left + self.total[last]
        live = np.arange(len(at))
        for k in range(length - 2, -1, -1):
            if alone:
                single = live[right[live] - left[live] <= 1]
                right[single] = left[single]
                live = live[right[live] - left[live] > 1]
            if not len(live):
                break
            symbol = self.codes[at[live] + k]
            both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([left[live], right[live]]))
            left[live], right[live] = self.first[symbol] + both[: len(live)], self.first[symbol] + both[len(live) :]
        return left, right
