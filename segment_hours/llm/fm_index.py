"""FM-index of a sequence of symbols: suffix array, wavelet matrix of its transform, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_array(text, symbols):
    """Order of the suffixes of ``text`` (integers 0 to ``symbols`` - 1); the end sorts before every symbol.

    The first sort compares as many symbols as fit into 63 bits; then only suffixes that are still equal are
    sorted again, by the ranks of what follows twice as far.
    """
    n = len(text)
    width = int(symbols).bit_length()
    step = max(1, 63 // width)
    key = np.zeros(n, np.int64)
    shifted = np.concatenate((np.asarray(text, np.int64) + 1, np.zeros(step, np.int64)))
    for i in range(step):
        key = (key << width) | shifted[i : i + n]
    order = np.argsort(key)
    key = key[order]
    fresh = np.concatenate((np.ones(min(n, 1), bool), key[1:] != key[:-1]))
    starts = np.flatnonzero(fresh)
    rank = np.empty(n, np.int64)
    rank[order] = starts[np.cumsum(fresh) - 1]
    sizes = np.diff(np.append(starts, n))
    rows = np.flatnonzero(np.repeat(sizes > 1, sizes))
    while len(rows):
        at = order[rows]
        behind = at + step
        second = np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + second
        sort = np.argsort(key)
        at, key = at[sort], key[sort]
        order[rows] = at
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        starts = np.flatnonzero(fresh)
        rank[at] = rows[starts][np.cumsum(fresh) - 1]
        sizes = np.diff(np.append(starts, len(rows)))
        rows = rows[np.repeat(sizes > 1, sizes)]
        step *= 2
    return order


class FMIndex:
    """Finds phrases in ``text``, whose symbol 0 parts sequences and never occurs in a phrase.

    Positions are kept for every ``sample``-th suffix and for those at the start of a sequence, so that a walk to a
    kept position never crosses a gap.
    """

    def __init__(self, text, symbols, sample=8):
        text = np.append(np.asarray(text, np.int64), 0)  # every sequence ends in a gap
        n = self.n = len(text)
        order = suffix_array(text, symbols)
        before = np.where(order > 0, text[order - 1], 0)
        kept = (order % sample == 0) | (before == 0)
        self.kept = kept
        self.kept_before = np.concatenate(([0], np.cumsum(kept)))
        self.positions = order[kept]
        counts = np.bincount(text, minlength=symbols)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        self.levels = []
        values = before
        places = np.zeros(symbols, np.int64)
        names = np.arange(symbols)
        for level in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            bits = (values >> level) & 1
            ones = np.concatenate(([0], np.cumsum(bits)))
            zeros = n - int(ones[-1])
            self.levels.append((level, ones, zeros))
            up = (names >> level) & 1 == 1
            places = np.where(up, zeros + ones[places], places - ones[places])
            values = np.concatenate((values[bits == 0], values[bits == 1]))
        self.base = self.first[:-1] - places

    def _step(self, symbols, rows):
        """Rows of the suffixes with ``symbols`` put in front: wavelet ranks down the levels."""
        for level, ones, zeros in self.levels:
            up = (symbols >> level) & 1 == 1
            seen = ones[rows]
            rows = np.where(up, zeros + seen, rows - seen)
        return self.base[symbols] + rows

    def _back(self, rows):
        """Rows of the suffixes one symbol longer; the symbol is read on the way down."""
        symbols = np.zeros(len(rows), np.int64)
        at = rows
        for level, ones, zeros in self.levels:
            seen = ones[at]
            up = ones[at + 1] > seen
            symbols |= up.astype(np.int64) << level
            at = np.where(up, zeros + seen, at - seen)
        return self.base[symbols] + at

    def search(self, phrases, lengths):
        """(first, last) rows of each phrase, by backward search; a row of ``phrases`` holds its symbols from the left."""
        first = np.zeros(len(phrases), np.int64)
        last = np.full(len(phrases), self.n, np.int64)
        alive = np.flatnonzero(lengths > 0)
        done = 0
        while len(alive):
            symbols = phrases[alive, lengths[alive] - 1 - done].astype(np.int64)
            first[alive] = self._step(symbols, first[alive])
            last[alive] = self._step(symbols, last[alive])
            done += 1
            alive = alive[(first[alive] < last[alive]) & (lengths[alive] > done)]
        return first, last

    def locate(self, first, last):
        """(phrase, position) of every occurrence of phrases with rows ``first`` to ``last``."""
        sizes = np.maximum(last - first, 0)
        phrase = np.repeat(np.arange(len(sizes)), sizes)
        rows = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[phrase]
        steps = np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.kept[rows])
        while len(walking):
            rows[walking] = self._back(rows[walking])
            steps[walking] += 1
            walking = walking[~self.kept[rows[walking]]]
        return phrase, self.positions[self.kept_before[rows]] + steps
