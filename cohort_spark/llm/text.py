"""Whole Arrow text columns as numpy arrays of words and word hashes.

A word is a maximal run of bytes other than space and 0x09-0x0D; UTF-8 keeps those bytes for themselves, so
words of bytes are words of characters.  Every function here works on a bounded slice of a record batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2 ** 64, kept for the next call."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 12), base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= 1 << 20:  # a single huge text must not leave its table behind
            _powers[int(base)] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the whole value."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@dataclass
class Words:
    """The words of some texts: byte ranges in ``data``; text ``i`` has words ``first[i]`` to ``first[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word; powers count from the start of the word, so their table stays small."""
        lengths = self.ends - self.starts
        if not len(lengths):
            return np.zeros(0, dtype=np.uint64)
        inside = np.flatnonzero(~_SPACE[self.data])
        first = np.zeros(len(lengths) + 1, dtype=np.int64)
        np.cumsum(lengths, out=first[1:])
        place = np.arange(len(inside), dtype=np.int64) - np.repeat(first[:-1], lengths)
        value = powers(_BASE, int(lengths.max()))[place]
        value *= self.data[inside] + np.uint64(1)
        return mix(np.add.reduceat(value, first[:-1]) + lengths.astype(np.uint64))

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """All words with one space after each, as bytes, and the place of each word (one more at the end)."""
        lengths = self.ends - self.starts
        place = np.zeros(len(lengths) + 1, dtype=np.int64)
        np.cumsum(lengths + 1, out=place[1:])
        out = np.full(int(place[-1]), 0x20, dtype=np.uint8)
        inside = np.flatnonzero(~_SPACE[self.data])
        out[np.arange(len(inside)) + np.repeat(np.arange(len(lengths)), lengths)] = self.data[inside]
        return out, place


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` word hashes (empty if there are fewer)."""
    if len(words) < size:
        return np.zeros(0, dtype=np.uint64)
    n = len(words)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(words * powers(_BASE, n), out=total[1:])
    return mix((total[size:] - total[:-size]) * powers(_BASE_INVERSE, n + 1)[: n - size + 1])


def raw(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offset of each text; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, dtype=np.uint8)
    return data, offsets


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each; a longer text is a range of its own."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        upto = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        upto = min(max(upto, row + 1), rows)
        yield row, upto
        row = upto


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """The words of the texts between ``offsets``."""
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    n = len(data)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return Words(data, none, none, np.zeros(len(offsets), dtype=np.int64))
    space = _SPACE[data]
    edge = offsets[(offsets > 0) & (offsets < n)]
    opens, closes = np.empty(n, dtype=bool), np.empty(n, dtype=bool)
    opens[0] = closes[-1] = True
    opens[1:], closes[:-1] = space[:-1], space[1:]
    opens[edge], closes[edge - 1] = True, True
    starts = np.flatnonzero(opens & ~space)
    ends = np.flatnonzero(closes & ~space) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))
