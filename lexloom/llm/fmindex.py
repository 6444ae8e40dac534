"""An FM-index of a sequence of integers: suffix array, Burrows-Wheeler transform, wavelet matrix, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of all suffixes in their order, the end of the text below every symbol; by doubling of sorted prefixes."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1
    order = np.argsort(rank, kind="stable")
    step = 1
    while n > 1:
        behind = np.zeros(n, dtype=np.int64)
        behind[:-step] = rank[step:]
        key = rank * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        new = np.empty(n, dtype=np.int64)
        new[order] = np.cumsum(np.r_[1, (np.diff(key[order]) != 0).astype(np.int64)])
        rank = new
        if rank.max() == n:
            break
        step *= 2
        if step >= n:
            break
    return order


class WaveletMatrix:
    """Symbols 0 to sigma - 1 of a sequence, one level of bits for each bit of a symbol, with counts of ones before each place."""

    def __init__(self, seq: np.ndarray, sigma: int) -> None:
        self.bits = max(1, int(sigma - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        now = seq.astype(np.int64)
        for level in reversed(range(self.bits)):
            bit = (now >> level) & 1
            self.ones.append(np.r_[0, np.cumsum(bit)])
            self.zeros.append(int(len(bit) - bit.sum()))
            now = np.concatenate([now[bit == 0], now[bit == 1]])
        self.origin = self._down(np.arange(sigma), np.zeros(sigma, dtype=np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            one = ones[at]
            at = np.where((symbol >> (self.bits - 1 - level)) & 1, zeros + one, at - one)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        return self._down(symbol, at) - self.origin[symbol]

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros(len(at), dtype=np.int64)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            one = ones[at]
            bit = ones[at + 1] - one
            symbol = symbol * 2 + bit
            at = np.where(bit == 1, zeros + one, at - one)
        return symbol


class FMIndex:
    """Finds places of patterns in a sequence of symbols from 1 to sigma - 1; 0 may stand in it as a separator."""

    def __init__(self, text: np.ndarray, sigma: int, sample: int = 8) -> None:
        order = suffix_array(np.r_[text, -1])  # the end itself is the least suffix
        before = np.r_[text, 0][order - 1]  # before the first symbol stands the end, counted as a separator
        self.wavelet = WaveletMatrix(before, sigma)
        self.end_row = int(np.flatnonzero(order == 0)[0])
        # A suffix that starts with symbol c lies behind the end's own row and those of lesser symbols.
        self.below = 1 + np.r_[0, np.cumsum(np.bincount(text, minlength=sigma))]
        self.known = order % sample == 0
        self.places = order[self.known]
        self.known_before = np.r_[0, np.cumsum(self.known)]
        self.rows = len(order)

    def _step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        fake = (symbol == 0) & (row > self.end_row)  # the end that stands before the first symbol is no separator of the text
        return self.below[symbol] + self.wavelet.rank(symbol, row) - fake

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of a matrix of symbols, the first and the end of the range of suffixes that start with it."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.rows, dtype=np.int64)
        for column in reversed(range(patterns.shape[1])):
            live = np.flatnonzero(low < high)
            if not len(live):
                break
            symbol = patterns[live, column]
            low[live], high[live] = self._step(symbol, low[live]), self._step(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Places in the text of suffixes given by row: steps back to the nearest sampled one."""
        row = row.copy()
        steps = np.zeros(len(row), dtype=np.int64)
        todo = np.flatnonzero(~self.known[row])
        while len(todo):
            at = row[todo]
            row[todo] = self._step(self.wavelet.access(at), at)
            steps[todo] += 1
            todo = todo[~self.known[row[todo]]]
        return self.places[self.known_before[row]] + steps
