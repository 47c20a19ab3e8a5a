"""Encoding with the pieces of a SentencePiece file by unigram Viterbi, and decoding.

The pieces lie in a double-array trie over bytes; in text and pieces the white-space marker is the byte of a space.  Pieces
have log scores; where a file ranks its pieces (score = -rank), the log score is that of a Zipf law, ``-log(1 + rank)``.
The encoding of a text is the segmentation with the largest sum; at equal sums, the one whose last piece is
longer (log scores are kept as integers, so equal sums are equal).  A character without a piece costs ``UNKNOWN`` below the worst piece and is written as its bytes.

No piece of the file goes past a marker that follows another character, so a text falls into units (markers and the
characters after them) that are segmented on their own; units are cached, and those not yet known are
segmented together, one numpy step per place and length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.llm.tokens import text_bytes

VOCABULARY = "piece_bpe_32k.model"
UNKNOWN = 10.0
UNIT = 1 << 20
_NEVER = -(1 << 62)
MARK = "▁"
CACHED_UNITS = 100_000
BATCH_UNITS = 20_000
#: Units of a block times its width: about 25 bytes each while the block is segmented.
BLOCK_CELLS = 1 << 20
#: Texts handled at once.
SLICE_ROWS = 500
TRIES = 32
_SCHEMA = "doc_id bigint, ids binary, n_bytes bigint"


class DoubleArray:
    """A trie in two arrays: the child of state ``s`` by byte ``c`` is ``base[s] + c`` if ``check`` there is ``s``."""

    def __init__(self, base: np.ndarray, check: np.ndarray, value: np.ndarray):
        self.base, self.check, self.value = base, check, value

    @classmethod
    def build(cls, keys: dict[bytes, int]) -> DoubleArray:
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for key, number in keys.items():
            node = 0
            for c in key:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    ends.append(-1)
                node = children[node][c]
            ends[node] = number
        size = 4 * len(children) + 1024
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        used = bytearray(size)
        used[0], value[0], low, place, queue = 1, ends[0], 1, {0: 0}, [0]
        for node in queue:
            codes = sorted(children[node])
            if not codes:
                continue
            low = used.index(0, low)
            at, tries = max(1, low - codes[0]), 0
            while any(used[at + c] for c in codes):
                at, tries = at + 1, tries + 1
                if tries == TRIES:  # this stretch is nearly full
                    low, tries = low + TRIES, 0
                    at = max(at, low - codes[0])
                if at + 512 > len(used):
                    used.extend(bytes(size))
                    base, check, value = np.append(base, np.zeros(size, np.int32)), *(np.append(x, np.full(size, -1, np.int32)) for x in (check, value))
            own = place[node]
            base[own] = at
            for c in codes:
                child = children[node][c]
                used[at + c] = 1
                check[at + c], value[at + c], place[child] = own, ends[child], at + c
                queue.append(child)
        return cls(base, check, value)

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The states after one more byte, -1 where there is none."""
        at = self.base[state] + code
        return np.where(self.check[at] == state, at, -1)


class Pieces:
    """The pieces of a file, ready to encode and decode whole texts."""

    def __init__(self, surfaces: list[bytes], scores: np.ndarray, normal: np.ndarray, byte_ids: np.ndarray):
        self.surfaces, self.byte_ids = surfaces, byte_ids
        self.scores = np.rint(scores * UNIT).astype(np.int64)
        self.normal = normal
        keys = [s for s, k in zip(surfaces, normal) if k]
        self.unknown = int(self.scores[normal].min()) - round(UNKNOWN * UNIT)
        self.longest = max(map(len, keys))
        self.by_unit = all(b" " not in s.lstrip(b" ") for s in keys)
        have = {c for s in keys for c in s}
        alone = b"".join(re.escape(bytes([c])) for c in (9, 10, 13) if c not in have)  # in no piece: a unit each
        self.splits = re.compile(b"[" + alone + b"]| *[^ " + alone + b"]+| +" if alone else b" *[^ ]+| +")
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    @cached_property
    def trie(self) -> DoubleArray:
        """Built by the workers that encode; those that decode do without."""
        return DoubleArray.build({s: i for i, s in enumerate(self.surfaces) if self.normal[i]})

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids (little-endian, unsigned, 32 bits) of each UTF-8 text."""
        split = [self._units(t) for t in texts]
        missing = list({u for units in split for u in units} - self.cache.keys())
        ready: dict[bytes, bytes] = {}
        fresh = []
        for unit in missing:
            known = self.older.get(unit)
            if known is None:
                fresh.append(unit)
            else:
                ready[unit] = known
        fresh.sort(key=len)  # units of about the same length share a block
        while fresh:
            width = len(fresh[-1])
            most = max(1, min(BATCH_UNITS, BLOCK_CELLS // (width + 1)))
            block, fresh = fresh[-most:], fresh[:-most]
            short = next((i for i, u in enumerate(block) if 2 * len(u) + 8 >= width), 0)
            block, fresh = block[short:], fresh + block[:short]
            ready.update(zip(block, self._segment(block)))
        if len(self.cache) + len(ready) > CACHED_UNITS:  # the units of the last generation stay at hand
            self.older, self.cache = self.cache, ready
            table = self.older | ready
        else:
            self.cache.update(ready)
            table = self.cache
        return [b"".join(map(table.__getitem__, units)) for units in split]

    def _units(self, text: bytes) -> list[bytes]:
        if not text:
            return []
        whole = b" " + text.replace(MARK.encode(), b"\xff")  # a written marker isn't a space: it goes by its bytes
        if not self.by_unit:
            return [whole]
        return self.splits.findall(whole)

    def _segment(self, units: list[bytes]) -> list[bytes]:
        """The best segmentation of each unit.  A 0xff byte stands for a written marker."""
        width = max(map(len, units))
        codes = np.zeros((len(units), width), dtype=np.uint8)
        length = np.array([len(u) for u in units])
        codes[np.arange(width)[None, :] < length[:, None]] = np.frombuffer(b"".join(units), dtype=np.uint8)
        best = np.full((len(units), width + 1), _NEVER, dtype=np.int64)
        best[:, 0] = 0
        piece = np.full((len(units), width + 1), -1, dtype=np.int32)
        size = np.zeros((len(units), width + 1), dtype=np.int32)
        inside = np.arange(width)[None, :] < length[:, None]
        opens = ((codes & 0xC0) != 0x80) | (codes == 0xFF)
        for i in range(width):
            rows = np.flatnonzero(inside[:, i] & opens[:, i] & (best[:, i] > _NEVER))
            if not len(rows):
                continue
            end = np.full(len(rows), i + 1)  # of the character
            for d in range(1, 4):
                if i + d < width:
                    end += (end == i + d) & inside[rows, i + d] & ~opens[rows, i + d]
            self._better(best, piece, size, rows, end, best[rows, i] + self.unknown, -2, end - i)
            state = np.zeros(len(rows), dtype=np.int64)
            for d in range(min(self.longest, width - i)):
                alive = inside[rows, i + d]
                rows, state = rows[alive], state[alive]
                state = self.trie.step(state, codes[rows, i + d])
                rows, state = rows[state >= 0], state[state >= 0]
                if not len(rows):
                    break
                number = self.trie.value[state]
                hit = number >= 0
                at = rows[hit]
                self._better(best, piece, size, at, i + d + 1, best[at, i] + self.scores[number[hit]], number[hit], d + 1)
        return [self._back(u, p, s) for u, p, s in zip(units, piece, size)]

    @staticmethod
    def _better(best, piece, size, rows, end, score, number, length) -> None:
        now = best[rows, end]
        up = score > now
        end = end[up] if isinstance(end, np.ndarray) else end
        rows = rows[up]
        best[rows, end] = score[up]
        piece[rows, end] = number[up] if isinstance(number, np.ndarray) else number
        size[rows, end] = length[up] if isinstance(length, np.ndarray) else length

    def _back(self, unit: bytes, piece: np.ndarray, size: np.ndarray) -> bytes:
        at, out = len(unit), []
        while at > 0:
            step = int(size[at])
            if piece[at] >= 0:
                out.append(int(piece[at]))
            else:
                body = unit[at - step : at].replace(b"\xff", MARK.encode())
                out += [int(self.byte_ids[c]) for c in reversed(body)]
            at -= step
        return np.array(out[::-1], dtype="<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        """The text of some ids: markers are spaces, byte pieces are bytes, and the space put before the text goes."""
        text = b"".join(map(self.surfaces.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
        return text[1:] if text[:1] == b" " else text


def load(path: str) -> Pieces:
    """The pieces of a SentencePiece file; ranks become log scores."""
    file = sentencepiece.SentencePieceProcessor(model_file=path)
    n = file.get_piece_size()
    surfaces, normal, byte_ids = [b""] * n, np.zeros(n, dtype=bool), np.full(256, -1, dtype=np.int64)
    raw = np.array([file.get_score(i) for i in range(n)])
    for i in range(n):
        text = file.id_to_piece(i)
        if file.is_byte(i):
            surfaces[i] = bytes([int(text[3:5], 16)])
            byte_ids[surfaces[i][0]] = i
        elif not (file.is_control(i) or file.is_unknown(i) or file.is_unused(i)):
            surfaces[i], normal[i] = text.replace(MARK, " ").encode(), True
    return Pieces(surfaces, -np.log1p(np.maximum(0, -raw)), normal, byte_ids)


@lru_cache(maxsize=2)
def pieces(path: str | None = None) -> Pieces:
    """The worker's pieces of a file."""
    return load(path or public_tokenizers.path(VOCABULARY))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, n_bytes) per row of ``docs`` (doc_id, text): ids as little-endian unsigned 32-bit binary, and how many are
    byte pieces.  Null and empty texts have no ids; an empty table gives no rows; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        low, high = int(model.byte_ids.min()), int(model.byte_ids.max())
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                ids = model.encode(text_bytes(part.column(1)))
                by_bytes = [int(((x >= low) & (x <= high)).sum()) for x in (np.frombuffer(i, dtype="<u4") for i in ids)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array(by_bytes, pa.int64())], names=["doc_id", "ids", "n_bytes"])

    return docs.select("doc_id", "text").mapInArrow(run, _SCHEMA)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``text``: what its ``ids`` say (null ids: null)."""
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                texts = [None if ids is None else model.decode(ids) for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary()).cast(pa.string())], names=[*names, "text"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{schema}, text string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_pieces, n_bytes, ids_crc32, decoded_crc32, decoded_chars): every text encoded, and its ids decoded."""
    decoded = decode(encode(docs, path), path)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_pieces"),
        "n_bytes",
        F.crc32("ids").alias("ids_crc32"),
        F.crc32("text").alias("decoded_crc32"),
        F.length("text").cast("bigint").alias("decoded_chars"),
    )
