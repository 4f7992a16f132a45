"""Minimal perfect hashing of distinct 64-bit keys, vectorised in numpy.

On each level the keys that are left are hashed to a bit array somewhat larger than
their number. A key that is alone at its place sets the bit and is done; the others go
on to the next level. The hash of a key is the rank of its bit among all set bits,
found from running totals of the 64-bit words. A key that was not among the keys may
get the slot of another one, or -1: callers keep the keys by slot and compare.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

ROOM = 1.25


class PerfectHash(NamedTuple):
    """Words of each level, and the bit arrays of all levels one after another."""

    sizes: np.ndarray
    words: np.ndarray
    before: np.ndarray

    @classmethod
    def of_words(cls, sizes: np.ndarray, words: np.ndarray) -> PerfectHash:
        totals = np.cumsum(np.bitwise_count(words).astype(np.int64))
        return cls(sizes, words, np.concatenate(([0], totals)))

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """The hash of keys that must be distinct."""
        sizes, levels, rest = [], [], keys
        while len(rest):
            size = int(len(rest) * ROOM) // 64 + 1
            at = _places(rest, len(sizes), size)
            found = np.bincount(at, minlength=64 * size)
            levels.append(np.packbits(found == 1, bitorder="little").view(np.uint64))
            sizes.append(size)
            rest = rest[found[at] > 1]
        words = np.concatenate(levels) if levels else np.zeros(0, np.uint64)
        return cls.of_words(np.array(sizes, np.int64), words)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, 0 to n - 1."""
        out, open_, start = np.full(len(keys), -1), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = _places(keys[open_], level, int(size))
            word, bit = start + at // 64, (at % 64).astype(np.uint64)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            word, bit, done = word[hit], bit[hit], open_[hit]
            lower = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[done] = self.before[word] + np.bitwise_count(lower)
            open_, start = open_[~hit], start + int(size)
        return out


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """Places in a level of `size` words: the finaliser of a 64-bit mix, with a start for each level."""
    x = keys.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return (x % np.uint64(64 * size)).astype(np.int64)
