"""The random numbers behind Spark ML's forests, drawn outside the JVM: bags, features of a node, order of the trees.

A forest of Spark ML is a function of its seed.  Whoever grows the same trees in another way needs the same draws, so the
generators are spelled out here: Well19937c (Commons Math), ``java.util.Random`` and Spark's ``XORShiftRandom``.
"""

from __future__ import annotations

import math

import numpy as np

WORD = 0xFFFFFFFF
LCG_MULTIPLIER, LCG_ADDEND, LCG_MASK = 0x5DEECE66D, 0xB, (1 << 48) - 1
STEPS = 1 << 14


class Bags:
    """How often each tree of a forest draws each row of a partition: Poisson numbers of mean 1, one after another."""

    #: Places of the ring in the order they are visited, with the places that are read there.
    RING = [(i, (i - 1) % 624, (i - 2) % 624, (i + 70) % 624, (i + 179) % 624, (i + 449) % 624) for i in (0, *range(623, 0, -1))]
    NONE = math.exp(-1.0)

    def __init__(self, seed: int):
        seed &= (1 << 64) - 1
        v = [seed >> 32, seed & WORD]
        for i in range(2, 624):
            signed = v[i - 2] - ((v[i - 2] & 0x80000000) << 1)
            v.append((1812433253 * (signed ^ (signed >> 30)) + i) & WORD)
        self._v, self._last, self._left, self._drawn, self._start = v, v[0], (0, 1.0), bytearray(), 0

    def _words(self) -> np.ndarray:
        """The next 624 words."""
        v, z4, out = self._v, self._last, []
        for i, a, b, c, d, e in self.RING:
            x1, x2, x3 = v[c], v[d], v[e]
            z1 = z4 ^ ((z4 << 25) & WORD) ^ x1 ^ (x1 >> 27)
            z2 = (x2 >> 9) ^ x3 ^ (x3 >> 1)
            z3 = z1 ^ z2
            z4 = (v[a] & 0x80000000) ^ (v[b] & 0x7FFFFFFF) ^ z1 ^ ((z1 << 9) & WORD) ^ z2 ^ ((z2 << 21) & WORD) ^ z3 ^ (z3 >> 21)
            v[i], v[a] = z3, z4
            out.append(z4)
        self._last = z4
        z = np.array(out, np.uint32)
        z ^= (z << np.uint32(7)) & np.uint32(0xE46E1700)
        return z ^ ((z << np.uint32(15)) & np.uint32(0x9B868000))

    def take(self, start: int, n: int) -> np.ndarray:
        """``n`` draws from the one numbered ``start`` on; none before the last ``forget`` can be asked for."""
        drawn = self._drawn
        while self._start + len(drawn) < start + n:
            half = (self._words() >> np.uint32(6)).astype(np.int64)
            k, r = self._left
            for x in (((half[::2] << 26) | half[1::2]) * 2.0**-52).tolist():
                r *= x
                if r >= self.NONE:
                    k += 1
                else:
                    drawn.append(k)
                    k, r = 0, 1.0
            self._left = (k, r)
        return np.frombuffer(bytes(drawn[start - self._start : start - self._start + n]), np.uint8)

    def forget(self, start: int) -> None:
        """Draws before ``start`` aren't needed any more."""
        if start - self._start > 1 << 20:
            del self._drawn[: start - self._start]
            self._start = start


def _steps() -> tuple[np.ndarray, np.ndarray]:
    """Multiplier and addend of 1 to STEPS steps of java.util.Random at once."""
    times, plus, m, a = [], [], 1, 0
    for _ in range(STEPS):
        m, a = m * LCG_MULTIPLIER & LCG_MASK, (a * LCG_MULTIPLIER + LCG_ADDEND) & LCG_MASK
        times.append(m)
        plus.append(a)
    return np.array(times, np.uint64), np.array(plus, np.uint64)


_MANY: list[tuple[np.ndarray, np.ndarray]] = []


def java_state(seed: int) -> int:
    return (seed ^ LCG_MULTIPLIER) & LCG_MASK


def java_longs(state: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The next ``n`` longs of java.util.Random, and its state after each."""
    if not _MANY:
        _MANY.append(_steps())
    times, plus = _MANY[0]
    found, left = [], 2 * n
    while left > 0:
        some = (times[:left] * np.uint64(state) + plus[:left]) & np.uint64(LCG_MASK)
        found.append(some)
        state, left = int(some[-1]), left - len(some)
    states = np.concatenate(found) if found else np.zeros(0, np.uint64)
    ints = (states >> np.uint64(16)).astype(np.uint32).view(np.int32).astype(np.int64)
    return (ints[::2] << 32) + ints[1::2], states[1::2]


def _bytes_hash(high: np.ndarray, low: np.ndarray, seed) -> np.ndarray:
    """Scala's MurmurHash3 of eight bytes, given as two little-endian words."""
    h = np.broadcast_to(np.uint32(seed) if np.isscalar(seed) else seed, high.shape).copy()
    for word in (high, low):
        k = word * np.uint32(0xCC9E2D51)
        k = ((k << np.uint32(15)) | (k >> np.uint32(17))) * np.uint32(0x1B873593)
        h ^= k
        h = ((h << np.uint32(13)) | (h >> np.uint32(19))) * np.uint32(5) + np.uint32(0xE6546B64)
    h ^= np.uint32(8)
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    return h ^ (h >> np.uint32(16))


def feature_subsets(seeds: np.ndarray, width: int, size: int) -> np.ndarray:
    """For each seed the ``size`` of ``width`` features that Spark's reservoir sampling keeps, in its order."""
    kept = np.tile(np.arange(size), (len(seeds), 1))
    words = seeds.astype(np.int64).view(np.uint64).byteswap()
    first, second = (words & np.uint64(WORD)).astype(np.uint32), (words >> np.uint64(32)).astype(np.uint32)
    low = _bytes_hash(first, second, 0x3C074A61)
    state = (_bytes_hash(first, second, low).astype(np.uint64) << np.uint64(32)) | low.astype(np.uint64)

    def bits(n: int) -> np.ndarray:
        nonlocal state
        state = state ^ (state << np.uint64(21))
        state = state ^ (state >> np.uint64(35))
        state = state ^ (state << np.uint64(4))
        return (state & np.uint64((1 << n) - 1)).astype(np.int64)

    for item in range(size, width):
        high = bits(26)
        at = (((high << 27) + bits(27)) * 2.0**-53 * (item + 1)).astype(np.int64)
        hit = np.flatnonzero(at < size)
        kept[hit, at[hit]] = item
    return kept


def map_order(keys: list[int]) -> list[int]:
    """The order in which Scala's immutable map, made of a mutable one, goes through small natural numbers."""
    if len(keys) <= 4:
        return sorted(keys, key=lambda k: (k & 15, k))

    def mixed(k: int) -> int:
        h = (k + ~(k << 9)) & WORD
        h ^= h >> 14
        h = (h + (h << 4)) & WORD
        return h ^ (h >> 10)

    def walk(some: list[tuple[int, int]], shift: int) -> list[int]:
        slots: dict[int, list[tuple[int, int]]] = {}
        for h, k in some:
            slots.setdefault((h >> shift) & 31, []).append((h, k))
        ordered = [slots[s] for s in sorted(slots)]
        return [x[0][1] for x in ordered if len(x) == 1] + [k for x in ordered if len(x) > 1 for k in walk(x, shift + 5)]

    return walk([(mixed(k), k) for k in keys], 0)
