"""Packing of token sequences by minimum bin slack.

Texts are encoded once; a text longer than a sequence is cut into full sequences and a rest.  Only the number of
pieces of each length decides how sequences are filled, and there are at most ``capacity`` lengths: the plan is made
on that histogram, whatever the number of texts, and pieces then find their place by their rank within their length.

The plan (minimum bin slack): a sequence starts with the longest piece left.  A subset-sum over the lengths left,
kept as one bitset per length, finds the sum closest to the room that is left; walking back through the bitsets gives
how many pieces of each length make up that sum.  The same filling is repeated as often as the counts allow.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohort_spark.llm.store import kept
from cohort_spark.llm.tokens import END_ID, encoder, text_bytes

CAPACITY = 2048
RANK_ROWS = 20_000
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def best_filling(counts: Mapping[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths with the largest sum of at most ``room``; ties use longer pieces first."""
    full, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if x <= room and counts[x] > 0), reverse=True):
        steps.append((length, reach))
        left, part = min(counts[length], room // length), 1
        while left > 0:  # shifts by 1, 2, 4 .. pieces reach every number of pieces up to the count
            part = min(part, left)
            reach |= (reach << (length * part)) & full
            left -= part
            part *= 2
        if reach >> room & 1:
            break
    target = reach.bit_length() - 1
    found: dict[int, int] = {}
    for length, before in reversed(steps):
        used = 0
        while not before >> target & 1:  # the fewest pieces of this length that the earlier lengths can complete
            target -= length
            used += 1
        if used:
            found[length] = used
    return found


@dataclass
class Filling:
    """``times`` sequences, each holding ``pieces`` (length -> count), numbered from ``first``."""

    first: int
    times: int
    pieces: dict[int, int]


def plan_fillings(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[Filling]:
    """Sequences for a histogram of piece lengths between 1 and ``capacity``."""
    left = {x: n for x, n in histogram.items() if n > 0}
    if any(not 1 <= x <= capacity for x in left):
        raise ValueError(f"piece lengths must lie between 1 and {capacity}")
    out, first = [], 0
    for longest in sorted(left, reverse=True):
        while left.get(longest, 0):
            left[longest] -= 1
            pieces = best_filling(left, capacity - longest)
            left[longest] += 1
            pieces[longest] = pieces.get(longest, 0) + 1
            times = min(left[x] // n for x, n in pieces.items())
            for x, n in pieces.items():
                left[x] -= n * times
                if not left[x]:
                    del left[x]
            out.append(Filling(first, times, pieces))
            first += times
    return out


class Seats:
    """Where the piece of a given rank among the pieces of its length goes."""

    def __init__(self, fillings: list[Filling]):
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        taken: dict[int, int] = {}
        for filling in fillings:
            offset = 0
            for length in sorted(filling.pieces, reverse=True):
                count = filling.pieces[length]
                rows.setdefault(length, []).append((taken.get(length, 0), filling.first, count, offset))
                taken[length] = taken.get(length, 0) + count * filling.times
                offset += count * length
        self.rows = {length: np.array(r, dtype=np.int64) for length, r in rows.items()}

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
        order = np.argsort(length, kind="stable")
        cuts = np.flatnonzero(np.diff(length[order])) + 1
        for rows in np.split(order, cuts) if len(order) else []:
            size = int(length[rows[0]])
            table = self.rows[size]
            row = table[np.searchsorted(table[:, 0], rank[rows], side="right") - 1]
            inside = rank[rows] - row[:, 0]
            sequence[rows] = row[:, 1] + inside // row[:, 2]
            offset[rows] = row[:, 3] + inside % row[:, 2] * size
        return sequence, offset


def cut_texts(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Encode whole texts and cut them into pieces of at most ``capacity`` ids, the end id included.

    One row per piece; ``with_ids`` adds the piece's ids as little-endian unsigned 32-bit binary.  A null or empty
    text is one piece that holds only the end id.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).ids
        end = int(END_ID).to_bytes(4, "little")
        for batch in batches:
            out: dict[str, list] = {"doc_id": [], "start": [], "length": [], "ids_crc32": [], "doc_tokens": [], "ids": []}
            for doc, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                ids = encode(text) + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    out["doc_id"].append(doc)
                    out["start"].append(start)
                    out["length"].append(len(part) // 4)
                    out["ids_crc32"].append(zlib.crc32(part))
                    out["doc_tokens"].append(total)
                    if with_ids:
                        out["ids"].append(part)
            if not with_ids:
                del out["ids"]
            yield pa.RecordBatch.from_pydict(
                out, schema=pa.schema([(k, pa.binary() if k == "ids" else pa.int64()) for k in out])
            )

    return docs.select("doc_id", "text").mapInArrow(pieces, PIECES + (", ids binary" if with_ids else ""))


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give each row of ``pieces`` (a ``length`` of 1 to ``capacity`` and any other columns) ``sequence_id`` and ``offset``.

    ``pieces`` is read more than once, so hand in a written table or a checkpoint.  The driver holds the histogram
    of lengths and the plan made of it, both bounded by ``capacity``.
    """
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    seats = Seats(plan_fillings(counts, capacity))
    # Ranks within a length: numbers within salted parts, plus the sizes of the parts before.
    parts = max(64, sum(counts.values()) // RANK_ROWS)
    order = ["doc_id", "start", "ids_crc32"]
    salted = pieces.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    numbered = salted.withColumn("__number", F.row_number().over(W.partitionBy("length", "__part").orderBy(*order)) - 1)
    sizes = salted.groupBy("length", "__part").agg(F.count("*").alias("__size"))
    before = sizes.select(
        "length",
        "__part",
        F.coalesce(
            F.sum("__size").over(W.partitionBy("length").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ).alias("__before"),
    )
    ranked = numbered.join(before, ["length", "__part"]).withColumn("__rank", F.col("__number") + F.col("__before"))
    ranked = ranked.select(*pieces.columns, F.col("__rank").cast("bigint").alias("__rank"))

    names = pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("__rank").to_numpy(zero_copy_only=False).astype(np.int64)
            sequence, offset = seats.place(length, rank)
            columns = [batch.column(c) for c in names] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(seat, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pack whole ``documents`` (``doc_id``, ``text``; other columns are ignored) into sequences of ``capacity`` ids.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids if asked for).
    Null or empty texts are pieces of one end id; repeated rows and null ids are packed like any other; an empty
    table gives no rows.  The pieces (five numbers each) are checkpointed: texts are encoded once.
    """
    return pack_pieces(kept(cut_texts(docs, capacity, tokenizer, with_ids)), capacity)
