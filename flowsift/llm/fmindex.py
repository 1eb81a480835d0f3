"""FM-index of a shard of words: wavelet ranks, backward search, sampled suffix positions."""

from __future__ import annotations

import numpy as np

#: Every so many text positions keep their place; a search walks fewer steps than this to one.
SAMPLE = 8


class FMIndex:
    """Index of runs of symbols from 1 on. Phrases never match across the end of a run."""

    def __init__(self, runs: np.ndarray, lengths: np.ndarray, symbols: int) -> None:
        """``runs`` holds the symbols of all runs one after another, ``symbols`` the largest one."""
        n, ends = len(runs) + len(lengths), np.cumsum(lengths) + np.arange(len(lengths))
        text = np.zeros(n, np.int64)
        text[np.setdiff1d(np.arange(n), ends, assume_unique=True)] = runs
        order = self._sorted(text, len(lengths))
        self.size = n
        before = text[order - 1]
        first = np.zeros(n, bool)
        first[np.concatenate([[0], ends[:-1] + 1]) if n else []] = True
        kept = (order % SAMPLE == 0) | first[order]
        self.sampled = kept
        self.places = np.where(kept, order, -1)
        self.start = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols + 1))])
        self.levels: list[tuple[np.ndarray, int]] = []
        row = before
        self.bits = max(1, int(symbols).bit_length())
        for level in reversed(range(self.bits)):
            bit = (row >> level) & 1
            self.levels.append((np.concatenate([[0], np.cumsum(bit)]), int(n - bit.sum())))
            row = np.concatenate([row[bit == 0], row[bit == 1]])
        self.base = self._down(np.arange(symbols + 1), np.zeros(symbols + 1, np.int64))

    @staticmethod
    def _sorted(text: np.ndarray, runs: int) -> np.ndarray:
        """Suffix order by doubling; run ends differ from each other, so it is strict."""
        n = len(text)
        rank = np.where(text == 0, np.cumsum(text == 0) - 1, runs + text)
        step = 1
        while True:
            later = np.zeros(n, np.int64)
            later[: n - step] = rank[step:] + 1
            key = rank * (max(n, int(rank.max(initial=0))) + 2) + later
            order = np.argsort(key, kind="stable")
            new = np.ones(n, np.int64)
            new[1:] = key[order][1:] != key[order][:-1]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new) - 1
            if new.all() or step >= n:
                return order
            step *= 2

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i, (ones, zeros) in enumerate(self.levels):
            bit = (symbol >> (self.bits - 1 - i)) & 1
            at = np.where(bit == 1, zeros + ones[at], at - ones[at])
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol precedes the first ``at`` suffixes."""
        return self._down(symbol, at) - self.base[symbol]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of the phrases, one per row; empty where one does not occur."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        for step in range(phrases.shape[1] if len(phrases) else 0):
            live = np.flatnonzero((lengths > step) & (low < high))
            symbol = phrases[live, lengths[live] - 1 - step]
            low[live] = self.start[symbol] + self.rank(symbol, low[live])
            high[live] = self.start[symbol] + self.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by walking back to sampled ones."""
        found, walked = np.full(len(rows), -1, np.int64), np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        rows = rows.copy()
        while len(open_):
            done = self.sampled[rows[open_]]
            at = open_[done]
            found[at] = self.places[rows[at]] + walked[at]
            open_ = open_[~done]
            at, symbol = rows[open_], np.zeros(len(open_), np.int64)
            for ones, zeros in self.levels:
                bit = ones[at + 1] - ones[at]
                symbol = symbol * 2 + bit
                at = np.where(bit == 1, zeros + ones[at], at - ones[at])
            rows[open_] = self.start[symbol] + at - self.base[symbol]
            walked[open_] += 1
        return found
