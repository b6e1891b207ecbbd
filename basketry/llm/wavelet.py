"""Wavelet matrix: ranks of small symbols in a long sequence, and places found from ranks."""

from __future__ import annotations

import numpy as np


class BitRanks:
    """A bit vector with the number of ones before every 64th place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    def ones(self, places: np.ndarray) -> np.ndarray:
        """Ones in the first ``places`` bits."""
        word, bit = places >> 6, (places & 63).astype(np.uint64)
        own = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(own)


class WaveletMatrix:
    """Symbols below ``2 ** levels``; level by level they are dealt out stably by their next bit, highest first."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.length = len(symbols)
        self.rows: list[tuple[int, BitRanks, int]] = []  # (level, its bits, zeros among them)
        for level in reversed(range(levels)):
            bits = (symbols >> level) & 1 == 1
            zeros = symbols[~bits]
            self.rows.append((level, BitRanks(bits), len(zeros)))
            symbols = np.concatenate([zeros, symbols[bits]])

    def rank(self, symbol: int, places: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands in the first ``places`` places."""
        low, high = np.zeros_like(places), places
        for level, bits, zeros in self.rows:
            a, b = bits.ones(low), bits.ones(high)
            low, high = (zeros + a, zeros + b) if symbol >> level & 1 else (low - a, high - b)
        return high - low

    def select(self, symbol: int, nth: np.ndarray) -> np.ndarray:
        """Place of the ``nth`` (from 1) ``symbol`` by bisection on ranks; it must be there."""
        low, high = np.zeros_like(nth), np.full_like(nth, self.length)
        while np.any(low < high):
            middle = (low + high) >> 1
            enough = self.rank(symbol, np.minimum(middle + 1, self.length)) >= nth
            open_ = low < high
            high = np.where(open_ & enough, middle, high)
            low = np.where(open_ & ~enough, middle + 1, low)
        return low
