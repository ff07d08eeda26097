"""A compressed full-text index over numbered words, searched for many patterns at once.

The index holds the Burrows-Wheeler transform of its text in a wavelet matrix: one bit vector per
bit of the alphabet, packed 64 to a word with a running count per word. Suffixes are sorted by
their first ``DEPTH`` symbols, which is all that patterns of up to ``DEPTH`` symbols can tell
apart: the suffixes that begin with a pattern of l symbols stand together, in the order of what
follows, as long as l is at most ``DEPTH``.
"""

from __future__ import annotations

import numpy as np

DEPTH = 16


class BitVector:
    """Packed bits with ``rank``: how many are set before each of some places."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros((len(bits) >> 6) + 1, np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        counts = np.bitwise_count(words).astype(np.int32)
        self.before = np.concatenate([np.zeros(1, np.int32), np.cumsum(counts[:-1], dtype=np.int32)])
        self.zeros = int(len(bits) - counts.sum())

    def rank(self, places: np.ndarray) -> np.ndarray:
        word = places >> 6
        below = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Counts of any symbol before any place, in one pass over the bits of the alphabet."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = []
        for shift in range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1):
            bits = (symbols >> shift & 1).astype(bool)
            self.levels.append((shift, BitVector(bits)))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])
        # Where each symbol's own run begins in the last arrangement.
        places = np.zeros(n_symbols, np.int64)
        every = np.arange(n_symbols)
        for shift, bits in self.levels:
            ones = bits.rank(places)
            places = np.where(every >> shift & 1, bits.zeros + ones, places - ones)
        self.begin = places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for shift, bits in self.levels:
            ones = bits.rank(places)
            places = np.where(symbols >> shift & 1, bits.zeros + ones, places - ones)
        return places - self.begin[symbols]


def sorted_suffixes(text: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """The places of a text in the order of the ``depth`` symbols from there, by doubling."""
    rank, span = text.astype(np.int64), 1
    while span < depth:
        follow = np.zeros(len(rank), np.int64)
        follow[:-span] = rank[span:] + 1
        _, rank = np.unique(rank * (len(rank) + int(text.max(initial=0)) + 2) + follow, return_inverse=True)
        span *= 2
    return np.argsort(rank, kind="stable")


class FMIndex:
    """Symbols of ``text`` are 0 for the end of a piece and 1 up for its words."""

    def __init__(self, text: np.ndarray):
        n_symbols = int(text.max(initial=0)) + 1
        self.order = sorted_suffixes(text)
        self.transform = WaveletMatrix(text[self.order - 1], n_symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])

    def intervals(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of ``patterns`` the range of suffixes that begin with it, by backward
        search: from the last symbol to the first, all rows at once."""
        last = patterns[:, -1]
        low, high = self.first[last].astype(np.int64), self.first[last + 1].astype(np.int64)
        for column in range(patterns.shape[1] - 2, -1, -1):
            symbol = patterns[:, column]
            base = self.first[symbol]
            both = self.transform.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
            low, high = base + both[: len(symbol)], base + both[len(symbol) :]
        return low, high
