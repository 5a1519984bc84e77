"""An FM-index over a sequence of word numbers: suffix order, wavelet matrix, backward search, sampled positions.

All steps work on NumPy arrays, so many phrases are searched, and many occurrences located, at once.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_order(ranks: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in ascending order, by prefix doubling."""
    n, width = len(ranks), 1
    rank = np.unique(ranks, return_inverse=True)[1].astype(np.int64)
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[:n - width] = rank[width:] + 1
        key = rank * (n + 1) + ahead
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], (key[1:] != key[:-1]).astype(np.int64)]))
        width *= 2
        if width >= n or rank[order[-1]] == n - 1:
            return order


class WaveletMatrix:
    """Counts of any symbol before any position, in one step per bit of the alphabet."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels = max(1, int(alphabet - 1).bit_length())
        self.before, self.zeros = [], []
        for bit in range(self.levels - 1, -1, -1):
            ones = (symbols >> bit) & 1
            self.before.append(np.concatenate([[0], np.cumsum(ones)]))
            self.zeros.append(len(symbols) - int(self.before[-1][-1]))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its end position."""
        start, end = np.zeros_like(end), end.copy()
        for bit, before, zeros in zip(range(self.levels - 1, -1, -1), self.before, self.zeros):
            one = ((symbol >> bit) & 1) == 1
            s, e = before[start], before[end]
            start = np.where(one, zeros + s, start - s)
            end = np.where(one, zeros + e, end - e)
        return end - start

    def at(self, place: np.ndarray) -> np.ndarray:
        """The symbol at each position."""
        place, symbol = place.copy(), np.zeros_like(place)
        for before, zeros in zip(self.before, self.zeros):
            ones = before[place]
            one = before[place + 1] - ones
            symbol = symbol * 2 + one
            place = np.where(one == 1, zeros + ones, place - ones)
        return symbol


class FMIndex:
    """Index of a sequence whose symbols are words (1 and up) and breaks (0), which no phrase crosses."""

    def __init__(self, sequence: np.ndarray, alphabet: int):
        n = len(sequence)
        breaks = sequence == 0
        unlike = np.where(breaks, np.cumsum(breaks) - 1, sequence + int(breaks.sum()))  # each break sorts by its place
        order = suffix_order(unlike)
        self.wavelet = WaveletMatrix(sequence[order - 1], alphabet)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=alphabet))])
        starts = np.concatenate([[True], breaks[:-1]])  # walking back stops where a run begins
        kept = (order % SAMPLE == 0) | starts[order]
        self.kept, self.kept_before = kept, np.cumsum(kept) - kept
        self.samples = order[kept]
        self.length = n

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of phrases, given right-aligned in a matrix that is padded with 0 on the left."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.length, np.int64)
        live = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            word = phrases[live, column]
            live, word = live[word > 0], word[word > 0]
            low[live] = self.first[word] + self.wavelet.rank(word, low[live])
            high[live] = self.first[word] + self.wavelet.rank(word, high[live])
            live = live[low[live] < high[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row, by walking back to the nearest sampled position."""
        rows, steps, out = rows.copy(), 0, np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            done = self.kept[rows[open_]]
            out[open_[done]] = self.samples[self.kept_before[rows[open_[done]]]] + steps
            open_ = open_[~done]
            word = self.wavelet.at(rows[open_])
            rows[open_] = self.first[word] + self.wavelet.rank(word, rows[open_])
            steps += 1
        return out
