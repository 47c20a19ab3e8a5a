"""Removal of repeated passages by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words.  The minimiser of a window is its smallest word gram, so equal windows have
equal minimisers.  Consecutive windows that share a minimiser travel as one packed string (a super-k-mer) to the
bucket of that minimiser.  There all windows of the bucket are sorted; equal windows meet, and the smallest document
of each is known exactly: windows that agree in their hash are compared byte by byte.

Only windows that can be repeated travel: where a minimiser has packed strings of one document alone, none of its windows
occurs in another one.  That is found out first, on the minimisers without the strings.

Grams that are frequent in the corpus come last in the order of minimisers.  A window then takes one of them only if
it has no other gram, that is, inside a frequent passage, where packed strings are equal and are merged before they
travel.  So no bucket holds more than a small share of the rows, however often a line or a passage occurs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_spark.llm.store import kept
from cohort_spark.llm.text import Words, grams, raw, slices, words_of

WINDOW = 50
GRAM = 6
#: A gram is frequent if it makes up this share of all grams or more; so there are at most 50,000 of them.
FREQUENT = 1 / 50_000
MAP_BYTES = 1 << 20
BUCKET_BYTES = 2 << 20
_NO_ID = (1 << 63) - 1
_FOUND = "bucket bigint, doc bigint, hash bigint, start bigint, n bigint, lead boolean"
_PACKED = "bucket bigint, packed binary, doc bigint, hash bigint, start bigint, n bigint"
_RANGES = "doc bigint, hash bigint, start bigint, stop bigint"
_LAST = np.uint64(1 << 63)


def _batch(names: str, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in names.split(", ")])


def _inside(words: Words, size: int) -> np.ndarray:
    """Whether the ``size`` words from each word on lie in one text."""
    left = np.repeat(words.first[1:], np.diff(words.first)) - np.arange(len(words.starts))
    return left[: max(0, len(left) - size + 1)] >= size


def _smallest(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest of each ``size`` consecutive values."""
    reach = 1
    while reach * 2 <= size:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = size - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def frequent_grams(docs: DataFrame, gram: int = GRAM, share: float = FREQUENT) -> np.ndarray:
    """Hashes of the grams that make up ``share`` of all grams, sorted: at most ``1 / share`` numbers.

    Counted over the whole table; grams too rare within a slice of a batch to matter are not handed on.  The list only
    balances buckets: any list gives the same result.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = raw(batch.column(0))
            for a, b in slices(offsets, MAP_BYTES):
                words = words_of(data, offsets[a : b + 1])
                inside = _inside(words, gram)
                found, n = np.unique(grams(words.hashes(), gram)[inside], return_counts=True)
                often = n >= max(3, share / 2 * inside.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.append(found[often].view(np.int64), 0)),
                        pa.array(np.append(n[often], 0).astype(np.int64)),
                        pa.array(np.append(np.zeros(often.sum(), np.int64), inside.sum()).astype(np.int64)),
                    ],
                    names=["gram", "n", "grams"],
                )

    counts = docs.select("text").mapInArrow(count, "gram bigint, n bigint, grams bigint")
    totals = kept(counts.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("grams").alias("grams")))
    every = totals.agg(F.sum("grams")).first()[0] or 0
    found = totals.where((F.col("n") > 0) & (F.col("n") >= every * share)).select("gram").collect()
    return np.sort(np.array([r["gram"] for r in found], dtype=np.int64).view(np.uint64))


def super_kmers(docs: DataFrame, frequent: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Where the super-k-mers of ``docs`` (doc, text, hash) lie: bucket, first word, number of windows.

    ``lead`` is false where a smaller document of the same slice has the same packed string: all of it is known to be
    repeated, so it needs no comparison, and equal strings of a slice are compared once.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc").to_numpy(zero_copy_only=False).astype(np.int64)
            marks = batch.column("hash").to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = raw(batch.column("text"))
            for a, b in slices(offsets, MAP_BYTES):
                found = _runs(words_of(data, offsets[a : b + 1]), ids[a:b], marks[a:b], frequent, window, gram)
                if found:
                    yield _batch(_FOUND, [pa.array(x) for x in found])

    return docs.select("doc", "text", "hash").mapInArrow(find, _FOUND)


def _runs(words: Words, ids, marks, frequent, window: int, gram: int) -> list[np.ndarray]:
    inside = _inside(words, window)
    if not inside.any():
        return []
    order = grams(words.hashes(), gram)
    rare = order >> np.uint64(1)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, order), len(frequent) - 1)
        rare = np.where(frequent[at] == order, rare | _LAST, rare)
    smallest = _smallest(rare, window - gram + 1)
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))[: len(smallest)]
    new = np.ones(len(smallest), dtype=bool)
    new[1:] = (smallest[1:] != smallest[:-1]) | (text[1:] != text[:-1]) | ~inside[:-1]
    begins = np.flatnonzero(new & inside)
    breaks = np.append(np.flatnonzero(new | ~inside), len(smallest))
    stops = breaks[np.searchsorted(breaks, begins, side="right")]  # one past the last window of the run
    doc, mark = ids[text[begins]], marks[text[begins]]
    body, place = words.joined()
    body = body.tobytes()
    strings = [body[x:y] for x, y in zip(place[begins].tolist(), (place[stops + window - 1] - 1).tolist())]
    owner = doc.tolist()
    first: dict[bytes, int] = {}
    for string, own in zip(strings, owner):
        if first.get(string, own) >= own:
            first[string] = own
    lead = np.fromiter((first[s] == d for s, d in zip(strings, owner)), dtype=bool, count=len(strings))
    spread = mark ^ (doc.astype(np.int64) * np.int64(0x5851F42D4C957F2D))  # copies of one text have one mark
    bucket = np.where(lead, smallest[begins].view(np.int64), spread)
    return [bucket, doc, mark, begins - words.first[text[begins]], stops - begins, lead]


def _listed(rows: DataFrame, *columns: str) -> DataFrame:
    """One row per different (document, text) with a set of entries.

    Rows that repeat name the same entries, so the set stays below two entries per word (a range may be a lead in one slice and
    known to be repeated in another).
    """
    keys = [F.col("doc").alias("__doc"), F.col("hash").alias("__hash")]
    return rows.groupBy(*keys).agg(F.collect_set(F.struct(*columns)).alias("__list"))


def pack(found: DataFrame, keyed: DataFrame) -> DataFrame:
    """The packed strings of super-k-mers whose bucket has leads of two documents; ranges known to be repeated have none."""
    bucket = W.partitionBy("bucket")
    shared = found.withColumns({"__low": F.min("doc").over(bucket), "__high": F.max("doc").over(bucket)})
    wanted = _listed(shared.where(~F.col("lead") | (F.col("__low") < F.col("__high"))), "bucket", "start", "n", "lead")

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            last, batch = _new_rows(batch, last)
            data, offsets = raw(batch.column("text"))
            for a, b in slices(offsets, MAP_BYTES):
                words = words_of(data, offsets[a : b + 1])
                body, place = words.joined()
                body, part = body.tobytes(), batch.slice(a, b - a)
                lists = part.column("__list")
                row = np.repeat(np.arange(b - a), lists.value_lengths().to_numpy())
                entry = lists.flatten()
                bucket, start, n, lead = (entry.field(i).to_numpy(zero_copy_only=False) for i in range(4))
                width = part.column("__window")[0].as_py()
                low = words.first[row] + start
                spans = zip(place[low].tolist(), (place[low + n + width - 1] - 1).tolist(), lead.tolist())
                packed = pa.array([body[x:y] if k else None for x, y, k in spans], pa.binary())
                doc, mark = (part.column(c).to_numpy()[row] for c in ("__doc", "__hash"))
                yield _batch(_PACKED, [pa.array(bucket), packed, *(pa.array(x) for x in (doc, mark, start, n))])

    return keyed.join(wanted, ["__doc", "__hash"]).mapInArrow(strings, _PACKED)


def _new_rows(batch: pa.RecordBatch, last: tuple | None) -> tuple[tuple | None, pa.RecordBatch]:
    """The rows that differ in document or text from the one before, and the last of all: a sort has brought equal ones together."""
    if not batch.num_rows:
        return last, batch
    doc, mark = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("__doc", "__hash"))
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])
    new[0] = (doc[0], mark[0]) != last
    return (doc[-1], mark[-1]), batch if new.all() else batch.take(pa.array(np.flatnonzero(new)))


def _groups(batches: Iterator[pa.RecordBatch], key: str, most: int) -> Iterator[pa.RecordBatch]:
    """Batches sorted by ``key``, cut anew between keys once they hold about ``most`` bytes."""
    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        held += batch.nbytes
        if held < most:
            continue
        table = pa.Table.from_batches(waiting).combine_chunks()
        keys = table.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], side="left"))
        if cut:
            yield from table.slice(0, cut).to_batches()
            rest = table.slice(cut).to_batches()
            waiting, held = rest, 0
        else:  # one key so far
            waiting, held = table.to_batches(), 0
    if waiting:
        yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()


def repeated_ranges(packed: DataFrame, window: int = WINDOW) -> DataFrame:
    """Word ranges that windows of smaller documents cover: (doc, hash, start, stop)."""

    def sort_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches, "bucket", BUCKET_BYTES):
            doc, mark, start, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "hash", "start", "n"))
            whole = np.asarray(batch.column("packed").is_null())
            yield _batch(_RANGES, [pa.array(x[whole]) for x in (doc, mark, start, start + n + window - 1)])
            rows = np.flatnonzero(~whole)
            if len(rows):
                strings = batch.column("packed").take(pa.array(rows))
                at, low, high = _found(strings, doc[rows], n[rows], window)
                rows = rows[at]
                yield _batch(_RANGES, [pa.array(x) for x in (doc[rows], mark[rows], start[rows] + low, start[rows] + high)])

    dealt = packed.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(sort_windows, _RANGES)


def _found(strings: pa.Array, doc: np.ndarray, n: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and word ranges (within the row's string) of windows that start in a smaller document too."""
    column = strings.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)
    words = words_of(data, offsets)
    row = np.repeat(np.arange(len(n)), n)  # of each window
    local = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    word = words.first[row] + local  # a window's first word
    hashes = grams(words.hashes(), window)[word]
    order = np.argsort(hashes, kind="stable")
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = hashes[order][1:] != hashes[order][:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(fresh) - 1
    lead = order[np.flatnonzero(fresh)][group]  # a window of the same hash to compare with
    body = words.data.tobytes()
    if not _same(body, words, word, row, lead, window):
        texts = [body[x:y] for x, y in zip(words.starts[word].tolist(), words.ends[word + window - 1].tolist())]
        seen: dict[bytes, int] = {}
        group = np.array([seen.setdefault(t, len(seen)) for t in texts], dtype=np.int64)
    first = np.full(int(group.max()) + 1, _NO_ID, dtype=np.int64)
    np.minimum.at(first, group, doc[row])
    again = first[group] < doc[row]
    opens = again.copy()
    opens[1:] &= ~(again[:-1] & (row[1:] == row[:-1]))
    closes = again.copy()
    closes[:-1] &= ~(again[1:] & (row[1:] == row[:-1]))
    begins, ends = np.flatnonzero(opens), np.flatnonzero(closes)
    return row[begins], local[begins], local[ends] + window


def _same(body: bytes, words: Words, word, row, lead, window: int) -> bool:
    """Whether each window has the bytes of its lead; runs of windows beside runs of leads are compared at once."""
    follows = np.zeros(len(word), dtype=bool)
    follows[1:] = (row[1:] == row[:-1]) & (lead[1:] == lead[:-1] + 1) & (row[lead[1:]] == row[lead[:-1]])
    begins = np.flatnonzero(~follows)
    ends = np.append(begins[1:], len(word)) - 1
    other = lead[begins] != begins
    begins, ends = begins[other], ends[other]
    spans = [words.starts[word[begins]], words.ends[word[ends] + window - 1]]
    spans += [words.starts[word[lead[begins]]], words.ends[word[lead[ends]] + window - 1]]
    return all(body[a:b] == body[c:d] for a, b, c, d in zip(*(s.tolist() for s in spans)))


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text``: the words left, one space between them.

    A word goes if it is covered by a window that also starts in a document with a smaller ``doc_id``; windows are
    those of the input.  Other columns stay; columns of the three names are replaced.  Null and empty texts have no
    words; a null id is larger than any; rows of one id don't remove each other's words; an empty table stays empty.
    """
    own = ["n_words", "n_removed", "kept_text"]
    docs = docs.drop(*own)
    keyed = docs.withColumns(
        {"__doc": F.coalesce("doc_id", F.lit(_NO_ID)), "__hash": F.xxhash64("text"), "__window": F.lit(window)}
    )
    plain = keyed.select(F.col("__doc").alias("doc"), "text", F.col("__hash").alias("hash"))
    gram = min(GRAM, window)
    found = super_kmers(plain, frequent_grams(docs, gram), window, gram)
    ranges = repeated_ranges(pack(found, keyed), window)
    listed = _listed(ranges, "start", "stop")
    names = docs.columns
    fields = [*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    schema = T.StructType([*fields, T.StructField("kept_text", T.StringType())])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = raw(batch.column("text"))
            for a, b in slices(offsets):
                part = batch.slice(a, b - a)
                n_words, n_removed, texts = _kept(words_of(data, offsets[a : b + 1]), part.column("__list").to_pylist())
                new = [pa.array(n_words), pa.array(n_removed), pa.array(texts, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + new, names=[*names, *own])

    # Both joins deal the same columns of ``docs`` by the same keys, so the texts are shuffled once.
    joined = keyed.join(listed, ["__doc", "__hash"], "left")
    return joined.mapInArrow(keep, schema)


def _kept(words: Words, ranges: list) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    body, place = words.joined()
    body = body.tobytes()
    n_words = np.diff(words.first)
    n_removed, texts = np.zeros(len(n_words), dtype=np.int64), []
    for i, found in enumerate(ranges):
        at, last = int(words.first[i]), int(words.first[i + 1])
        if not found:
            texts.append(body[place[at] : place[last] - 1] if last > at else b"")
            continue
        parts, upto = [], 0
        for r in sorted((r["start"], r["stop"]) for r in found):
            if r[0] > upto:
                parts.append(body[place[at + upto] : place[at + r[0]] - 1])
            n_removed[i] += max(0, r[1] - max(upto, r[0]))
            upto = max(upto, r[1])
        if at + upto < last:
            parts.append(body[place[at + upto] : place[last] - 1])
        texts.append(b" ".join(parts))
    return n_words, n_removed, texts
