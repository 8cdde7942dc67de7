"""Minimal perfect hashes of sets of words, with the words stored for verification."""

from __future__ import annotations

import numpy as np

from segment_hours.llm.common import Words, fmix

# Bits of a level for each key that it gets, and levels before the last keys are listed.
SPREAD = 1.6
LEVELS = 40


def hashes_of(words):
    """64-bit hashes of words that hold no white space."""
    return Words([b" ".join(words)]).hashes


class PerfectHash:
    """Gives each of ``keys`` (distinct, as bytes) an own number from 0 to len(keys) - 1, and None to any other word.

    Level after level, the keys that are alone at their bit settle there; the number of a key is the count of bits set
    before its own. The word stored under the number decides whether a word is a key at all.
    """

    def __init__(self, keys):
        hashes = hashes_of(keys)
        waiting = np.arange(len(keys))
        self.sizes, bits = [], []
        while len(waiting) and len(self.sizes) < LEVELS:
            size = int(len(waiting) * SPREAD) + 8
            at = self._at(hashes[waiting], len(self.sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            self.sizes.append(size)
            bits.append(alone)
            waiting = waiting[~alone[at]]
        self.bits = np.concatenate(bits) if bits else np.zeros(0, bool)
        self.before = np.concatenate(([0], np.cumsum(self.bits)))
        # Keys that share all their bits, by far unlikely, are listed.
        n = int(self.before[-1])
        self.rest = {keys[k]: n + i for i, k in enumerate(waiting.tolist())}
        self.keys = np.empty(len(keys), object)
        number = self._numbers(hashes)
        settled = np.ones(len(keys), bool)
        settled[waiting] = False
        self.keys[number[settled]] = np.array(keys, object)[settled] if len(keys) else []
        for key, i in self.rest.items():
            self.keys[i] = key

    @staticmethod
    def _at(hashes, level, size):
        salt = np.uint64((level * 0x9E3779B97F4A7C15 + 0x2545F4914F6CDD1D) % (1 << 64))
        return (fmix(hashes ^ salt) % np.uint64(size)).astype(np.int64)

    def _numbers(self, hashes):
        """Number of the first set bit of each hash, -1 without one."""
        number = np.full(len(hashes), -1, np.int64)
        waiting, start = np.arange(len(hashes)), 0
        for level, size in enumerate(self.sizes):
            at = self._at(hashes[waiting], level, size) + start
            hit = self.bits[at]
            number[waiting[hit]] = self.before[at[hit]]
            waiting, start = waiting[~hit], start + size
        return number

    def lookup(self, words, hashes=None):
        """Numbers of ``words``, -1 for words that are no keys."""
        number = self._numbers(hashes_of(words) if hashes is None else hashes)
        for i in np.flatnonzero(number < 0).tolist() if self.rest else ():
            number[i] = self.rest.get(words[i], -1)
        found = np.flatnonzero(number >= 0)
        same = np.fromiter((k == words[i] for k, i in zip(self.keys[number[found]], found.tolist(), strict=True)), bool, len(found))
        number[found[~same]] = -1
        return number
