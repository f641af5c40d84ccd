"""A compressed FM-index over integer symbols, searched for many patterns at once.

The Burrows-Wheeler transform is held in a wavelet matrix: one packed bit
vector a level, with a running count every 64 bits.  Suffixes are ordered by their
first 8 symbols only (three prefix doublings), which is enough for exact counts of
patterns of up to 8 symbols.  Symbol 0 separates texts and never matches.
"""

from __future__ import annotations

import numpy as np

DEPTH = 8
U = np.uint64


class BitVector:
    """Packed bits with rank."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.zeros((n // 64 + 1) * 8, np.uint8)
        packed[: -(-n // 8)] = np.packbits(bits, bitorder="little")
        self.words = packed.view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]).astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        k = i >> 6
        return self.before[k] + np.bitwise_count(self.words[k] & ((U(1) << (i & 63).astype(np.uint64)) - U(1)))


class WaveletMatrix:
    """Rank of a symbol before a position, by one bit vector for each bit of the symbols."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels: list[tuple[int, BitVector, int]] = []
        at = symbols
        for bit in reversed(range(max(1, int(sigma - 1).bit_length()))):
            one = (at >> bit & 1).astype(bool)
            self.levels.append((bit, BitVector(one), int(len(at) - one.sum())))
            at = np.concatenate([at[~one], at[one]])

    def descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where position i stands on the last level, when followed as the symbol."""
        for bit, vector, zeros in self.levels:
            ones = vector.rank(i)
            i = np.where(symbol >> bit & 1 == 1, zeros + ones, i - ones)
        return i


class FMIndex:
    def __init__(self, symbols: np.ndarray, labels: np.ndarray):
        """``symbols``: integers from 0 on, 0 between texts and at the end; ``labels``: a small number of each place's text.

        Kept are the wavelet matrix, the first rows of symbols and the labels in the order of suffixes, not that order.
        """
        n = len(symbols)
        rank = symbols.astype(np.int64)
        for width in (1, 2, 4):
            second = np.zeros(n, np.int64)
            second[: max(0, n - width)] = rank[width:]
            _, rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + second, return_inverse=True)
        order = np.argsort(rank, kind="stable")
        self.labels = labels[order]
        sigma = int(symbols.max(initial=0)) + 1
        self.matrix = WaveletMatrix(symbols[order - 1], sigma)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=sigma))])
        all_symbols = np.arange(sigma)
        self._lead = self.first[:-1] - self.matrix.descend(all_symbols, np.zeros(sigma, np.int64))

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The smallest label of each (not empty) interval of suffixes."""
        labels = np.append(self.labels, self.labels[-1:])
        pairs, which = np.unique(low.astype(np.int64) * len(labels) + high, return_inverse=True)
        edges = np.stack([pairs // len(labels), pairs % len(labels)], axis=1).ravel()
        return np.minimum.reduceat(labels, edges)[::2][which]

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One backward step: the suffix interval of the symbol followed by the pattern of [low, high)."""
        lead = self._lead[symbol]
        return lead + self.matrix.descend(symbol, low), lead + self.matrix.descend(symbol, high)

    def match(self, patterns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of many patterns of equal length (one array for each place in the pattern).

        Returns the matching statistic (how many symbols from the end occur together) and the interval of that match.
        """
        if len(patterns) > DEPTH:
            raise ValueError("patterns are too long for the order of this index")
        last = patterns[-1]
        low, high = self.first[last], self.first[last + 1]
        found = ((last > 0) & (high > low)).astype(np.int64)
        live = np.flatnonzero(found)
        for symbol in reversed(patterns[:-1]):
            live = live[symbol[live] > 0]
            lo, hi = self.step(symbol[live], low[live], high[live])
            some = hi > lo
            live = live[some]
            low[live], high[live] = lo[some], hi[some]
            found[live] += 1
        return found, low, high
