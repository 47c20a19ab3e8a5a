"""Minimal perfect hashing of 64-bit keys with stored fingerprints, as numpy arrays.

Keys are tried level by level: a key that is alone at its place in a level's bit array stays there, the others go on
to the next level.  The number of a key is the count of set bits before its own, so ``n`` keys get the numbers 0 to
``n - 1``; a fingerprint per number tells keys of the set from others.
"""

from __future__ import annotations

import numpy as np

from cohort_spark.llm.text import mix

SPARE = 2.0
_LEVEL = 0xA0761D6478BD642F
_PRINT = np.uint64(0xE7037ED1A0B428DB)


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64((level + 1) * _LEVEL & (1 << 64) - 1)
    return (mix(keys ^ salt) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """``sizes`` (bits per level), ``bits`` (all levels, packed) and ``prints`` (32-bit fingerprint per number)."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, prints: np.ndarray):
        self.sizes, self.bits, self.prints = sizes, bits, prints
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.set = np.unpackbits(bits)[: int(self.first[-1])].astype(bool)
        self.rank = np.concatenate([[0], np.cumsum(self.set)]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """A hash of distinct int64 keys."""
        left = keys.astype(np.int64).view(np.uint64)
        sizes, levels = [], []
        while len(left):
            size = -(-max(8, int(SPARE * len(left))) // 8) * 8
            place = _places(left, len(sizes), size)
            alone = np.bincount(place, minlength=size)[place] == 1
            bits = np.zeros(size, dtype=bool)
            bits[place[alone]] = True
            sizes.append(size)
            levels.append(bits)
            left = left[~alone]
        bits = np.packbits(np.concatenate(levels)) if levels else np.zeros(0, dtype=np.uint8)
        made = cls(np.array(sizes, dtype=np.int64), bits, np.zeros(len(keys), dtype=np.uint32))
        made.prints[made._numbers(keys)] = cls._print(keys)
        return made

    @staticmethod
    def _print(keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.int64).view(np.uint64) + _PRINT) >> np.uint64(32)).astype(np.uint32)

    def _numbers(self, keys: np.ndarray) -> np.ndarray:
        left = keys.astype(np.int64).view(np.uint64)
        number = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = self.first[level] + _places(left[open_], level, int(size))
            hit = self.set[at]
            number[open_[hit]] = self.rank[at[hit]]
            open_ = open_[~hit]
        return number

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for a key whose fingerprint isn't stored (up to 1 in 2 ** 32 of foreign keys)."""
        number = self._numbers(keys)
        known = number >= 0
        known[known] = self.prints[number[known]] == self._print(keys[known])
        return np.where(known, number, -1)
