"""An FM-index over a sequence of numbers, searched for many patterns at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SAMPLE_EVERY = 8
LOCATE_AT_ONCE = 1 << 20


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order, by doubling the compared length."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        key = rank * (n + 1)
        key[:-width or None] += rank[width:] + 1
        order = np.argsort(key)
        ordered = key[order]
        new = np.zeros(n, dtype=np.int64)
        np.cumsum(ordered[1:] != ordered[:-1], out=new[1:])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        width *= 2
        if new[-1] == n - 1 or width >= n:
            return order


class WaveletTree:
    """Ranks of symbols in a sequence: one level of bits per bit of a symbol, the highest first."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.bits = max(1, int(symbols - 1).bit_length())
        self.zeros, self.rank0 = [], []
        for level in reversed(range(self.bits)):
            bit = (values >> level) & 1 == 1
            rank0 = np.zeros(len(values) + 1, dtype=np.int32)
            np.cumsum(~bit, out=rank0[1:])
            self.rank0.append(rank0)
            self.zeros.append(int(rank0[-1]))
            values = np.concatenate([values[~bit], values[bit]])
        self.base = self._down(np.arange(1 << self.bits), np.zeros(1 << self.bits, dtype=np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i, level in enumerate(reversed(range(self.bits))):
            zeros_before = self.rank0[i][at]
            at = np.where((symbol >> level) & 1 == 1, self.zeros[i] + at - zeros_before, zeros_before)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        return self._down(symbol, at) - self.base[symbol]


class FMIndex:
    """``text`` holds symbols 1 to symbols-1; 0 is the end mark."""

    def __init__(self, text: np.ndarray, symbols: int):
        closed = np.append(text, 0)
        order = suffix_array(closed)
        self.last = closed[order - 1]
        self.first = np.zeros(symbols + 1, dtype=np.int64)
        np.cumsum(np.bincount(closed, minlength=symbols), out=self.first[1:])
        self.tree = WaveletTree(self.last, symbols)
        self.size = len(closed)
        sampled = order % SAMPLE_EVERY == 0
        self.sample_rank = np.zeros(len(closed) + 1, dtype=np.int64)
        np.cumsum(sampled, out=self.sample_rank[1:])
        self.sampled, self.samples = sampled, order[sampled]

    def _step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.first[symbol] + self.tree.rank(symbol, at)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each pattern (rows of equal length), from its end backwards."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.size, dtype=np.int64)
        alive = np.arange(len(patterns))
        for j in reversed(range(patterns.shape[1])):
            symbol = patterns[alive, j]
            low[alive], high[alive] = self._step(symbol, low[alive]), self._step(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
            if not len(alive):
                break
        found = np.zeros(len(patterns), dtype=bool)
        found[alive] = True
        return np.where(found, low, 0), np.where(found, high, 0)

    def locate(self, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(pattern, position) of all occurrences, in blocks of bounded size."""
        before = np.concatenate([[0], np.cumsum(high - low)])
        for start in range(0, int(before[-1]), LOCATE_AT_ONCE):
            number = np.arange(start, min(start + LOCATE_AT_ONCE, int(before[-1])))
            pattern = np.searchsorted(before, number, side="right") - 1
            yield pattern, self._positions(low[pattern] + number - before[pattern])

    def _positions(self, row: np.ndarray) -> np.ndarray:
        """Walk back from each suffix until one whose position is kept."""
        position, walked, left = np.zeros_like(row), 0, np.arange(len(row))
        row = row.copy()
        while len(left):
            at = row[left]
            there = self.sampled[at]
            position[left[there]] = self.samples[self.sample_rank[at[there]]] + walked
            left, at = left[~there], at[~there]
            row[left] = self._step(self.last[at], at)
            walked += 1
        return position
