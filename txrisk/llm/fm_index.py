"""An FM-index over a sequence of words: suffix sorting, wavelet-tree ranks, backward search and sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of an integer sequence whose last symbol is its only 0, by prefix doubling.

    The first sort compares as many symbols as fit into 60 bits; later rounds touch only suffixes that still tie.
    """
    n = len(text)
    bits = max(1, int(text.max(initial=0)).bit_length())
    h = max(1, 60 // bits)
    key, padded = np.zeros(n, np.int64), np.append(text, np.zeros(h, np.int64))
    for k in range(h):
        key = (key << bits) | padded[k : k + n]
    order = np.argsort(key, kind="stable")
    new = np.append(True, key[order][1:] != key[order][:-1])
    starts = np.flatnonzero(new)
    group = np.repeat(starts, np.diff(np.append(starts, n)))
    rank = np.empty(n, np.int64)  # places of suffixes, of a tied group its first
    rank[order] = group
    tied = order[(np.diff(np.append(starts, n)) > 1)[np.cumsum(new) - 1]]
    while len(tied):
        ahead = tied + h
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        first = rank[tied]
        by = np.argsort(first * (n + 1) + second, kind="stable")
        tied, first, second = tied[by], first[by], second[by]
        in_group = np.append(True, first[1:] != first[:-1])
        new = in_group | np.append(True, second[1:] != second[:-1])
        at = np.arange(len(tied))
        group_start, sub_start = (np.maximum.accumulate(np.where(x, at, 0)) for x in (in_group, new))
        rank[tied] = first + sub_start - group_start
        sizes = np.diff(np.append(np.flatnonzero(new), len(tied)))
        tied = tied[np.repeat(sizes > 1, sizes)]
        h *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


class FMIndex:
    """Index of a sequence of symbols from 1 up; :meth:`find` gives the places where patterns occur."""

    def __init__(self, symbols: np.ndarray, sample: int = 16):
        text = np.append(symbols, 0).astype(np.int64)
        order = suffix_array(text)
        self.n = len(text)
        self.last = text[order - 1]  # the Burrows-Wheeler transform
        self.levels = max(1, int(text.max()).bit_length())
        counts = np.bincount(text, minlength=1 << self.levels)
        self.below = np.cumsum(counts) - counts
        # the wavelet tree's levels, laid out as a matrix: counts of ones before each place, and the number of zeros
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        held = self.last
        for level in reversed(range(self.levels)):
            bit = (held >> level) & 1 == 1
            self.ones.append(np.append(0, np.cumsum(bit)).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            held = np.concatenate([held[~bit], held[bit]])
        every = np.arange(len(counts))
        self.base = self._descend(every, np.zeros(len(every), np.int64))
        kept = order % sample == 0
        self.kept_before = np.append(0, np.cumsum(kept)).astype(np.int32)
        self.samples = order[kept]

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, ones, zeros in zip(reversed(range(self.levels)), self.ones, self.zeros):
            one = ones[at]
            at = np.where((symbol >> level) & 1 == 1, zeros + one, at - one)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often a symbol stands before a place of the transform."""
        return self._descend(symbol, at) - self.base[symbol]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of ``patterns`` that occur, and the range of suffixes that each begins."""
        which = np.arange(len(patterns))
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for k in reversed(range(patterns.shape[1])):
            symbol = patterns[which, k]
            inside = symbol < len(self.below)
            which, symbol, low, high = which[inside], symbol[inside], low[inside], high[inside]
            low = self.below[symbol] + self.rank(symbol, low)
            high = self.below[symbol] + self.rank(symbol, high)
            there = low < high
            which, low, high = which[there], low[there], high[there]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by stepping back to a sampled one."""
        out, steps, open_ = np.empty(len(rows), np.int64), 0, np.arange(len(rows))
        rows = rows.copy()
        while len(open_):
            here = rows[open_]
            kept = self.kept_before[here + 1] > self.kept_before[here]
            out[open_[kept]] = self.samples[self.kept_before[here[kept]]] + steps
            open_, here = open_[~kept], here[~kept]
            symbol = self.last[here]
            rows[open_] = self.below[symbol] + self.rank(symbol, here)
            steps += 1
        return out

    def find(self, patterns: np.ndarray, block: int = 1 << 20):
        """Blocks of ``(pattern, position)`` arrays, one pair for each occurrence."""
        which, low, high = self.search(patterns)
        ends = np.cumsum(high - low)
        at = 0
        while at < len(which):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + block, side="right")))
            size = (high - low)[at:to]
            begins = np.cumsum(size) - size
            rows = np.arange(int(size.sum())) + np.repeat(low[at:to] - begins, size)
            yield np.repeat(which[at:to], size), self.locate(rows)
            at = to
