"""An FM-index over word ids in numpy: suffix order, wavelet-matrix ranks, sampled suffix positions.

Symbol 0 separates runs of words. Each separator counts as a symbol of its own in the suffix order, so no
comparison goes past the end of a run, and no search goes through one.
"""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only suffixes that are still tied are sorted again."""
    n = len(symbols)
    gaps = symbols == 0
    first = symbols.astype(np.int64) + int(gaps.sum())
    first[gaps] = np.arange(int(gaps.sum()))
    sa = np.argsort(first, kind="stable")
    rank = np.empty(n + 1, np.int64)  # of a suffix: the place in sa where its group of ties begins
    rank[n] = -1
    key = first[sa]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    rank[sa] = np.repeat(starts, np.diff(np.r_[starts, n]))
    width = 1
    while True:
        own = rank[sa]
        same = own[1:] == own[:-1]
        tied = np.flatnonzero(np.r_[same, False] | np.r_[False, same])
        if not len(tied):
            return sa
        who = sa[tied]
        group, after = rank[who], rank[np.minimum(who + width, n)]
        order = np.lexsort((after, group))
        who, group, after = who[order], group[order], after[order]
        sa[tied] = who
        new = np.r_[True, (group[1:] != group[:-1]) | (after[1:] != after[:-1])]
        rank[who] = tied[np.flatnonzero(new)][np.cumsum(new) - 1]
        width *= 2


class WaveletMatrix:
    """Counts of a symbol before a place, for many symbols and places at once."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.levels - 1, -1, -1):
            bits = (symbols >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bits, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(len(symbols) - int(self.ones[-1][-1]))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def _down(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for level, ones, zeros in zip(range(self.levels - 1, -1, -1), self.ones, self.zeros, strict=True):
            before = ones[places]
            places = np.where((symbols >> level) & 1, zeros + before, places - before)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        return self._down(symbols, places) - self._down(symbols, np.zeros_like(places))


class FMIndex:
    """symbols: runs of ids from 1 to sigma, with a 0 after each run."""

    def __init__(self, symbols: np.ndarray, sigma: int, sample: int = 8):
        sa = suffix_order(symbols)
        self.bwt = symbols[sa - 1]  # of the first suffix: the last symbol, a separator
        self.matrix = WaveletMatrix(self.bwt, sigma)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=sigma + 1))])
        kept = (sa % sample == 0) | (self.bwt == 0)  # a run's first word is always sampled
        self.sampled, self.sample_at, self.samples = kept, np.cumsum(kept) - 1, sa[kept]

    def back(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        return self.first[symbols] + self.matrix.rank(symbols, places)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """phrases: ids aligned at the right. Returns the found ones' numbers and ranges in the suffix order."""
        who = np.arange(len(phrases))
        last = phrases[:, -1]
        low, high = self.first[last], self.first[last + 1]
        found = []
        for step in range(1, phrases.shape[1] + 1):
            done = lengths[who] == step
            live = low < high
            found.append((who[done & live], low[done & live], high[done & live]))
            go = live & ~done
            who, low, high = who[go], low[go], high[go]
            if not len(who):
                break
            symbol = phrases[who, phrases.shape[1] - 1 - step]
            low, high = self.back(symbol, low), self.back(symbol, high)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix order, walked back to the next sampled one."""
        out = np.zeros(len(rows), np.int64)
        index, steps, rows = np.arange(len(rows)), 0, rows.copy()
        while len(rows):
            hit = self.sampled[rows]
            out[index[hit]] = self.samples[self.sample_at[rows[hit]]] + steps
            index, rows = index[~hit], rows[~hit]
            rows = self.back(self.bwt[rows], rows)
            steps += 1
        return out
