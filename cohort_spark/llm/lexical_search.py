"""Exact ranked lexical search in sparse ball trees.

A document is a sparse vector: per term that any item asks for, its integer weight there.  An item is the vector of its
term counts, and a score is their inner product.  Every task builds ball trees over its documents: a node knows the centroid
of its documents and the radius around it, so no document below it scores more than ``item . centroid + |item| * radius``.
Trees are searched best-first per item; a node whose bound, enlarged by all that rounding could have taken from it, is below the
item's tenth score so far is never opened.  Leaves are scored in 64-bit integers.

A task's trees share the best scores found so far, and hand on at most ``k`` documents per item; those meet in one ranking.
Items are handled in blocks whose terms are of bounded size, because every task holds one block.  Terms are compared as 64-bit
hashes: a document's term meets a different one of a block with a probability below 2e-14.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohort_spark.llm.store import kept
from cohort_spark.llm.text import raw, slices, words_of

K = 10
LEAF = 64
SLIMMEST = 16
TREE_DOCS = 8192
TREE_ENTRIES = 1 << 20
BLOCK_TERMS = 1 << 18
_TERM = np.full(256, 0x20, dtype=np.uint8)  # bytes that aren't part of a term become spaces, A-Z become a-z
_TERM[0x30:0x3A] = np.arange(0x30, 0x3A)
_TERM[0x61:0x7B] = np.arange(0x61, 0x7B)
_TERM[0x41:0x5B] = np.arange(0x61, 0x7B)
_TERM[0x80:] = np.arange(0x80, 0x100)
_EPS = np.finfo(float).eps


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every term of some texts, and the place of each text's first one."""
    words = words_of(_TERM[data[offsets[0] : offsets[-1]]], offsets - offsets[0])
    return words.hashes(), words.first


@dataclass
class Items:
    """A block of items: ``vocabulary`` holds their terms' hashes in order; item ``i`` has ``term`` and ``count`` from
    ``first[i]`` to ``first[i + 1]``."""

    ids: list
    vocabulary: np.ndarray
    first: np.ndarray
    term: np.ndarray
    count: np.ndarray


def item_blocks(items: DataFrame) -> Iterator[Items]:
    """Items with a term, in blocks of about ``BLOCK_TERMS`` terms; a block is all that the driver and each task hold."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = raw(batch.column("text"))
            for a, b in slices(offsets):
                hashes, first = terms_of(data, offsets[a : b + 1])
                rows = [hashes[x:y].view(np.int64).tolist() for x, y in zip(first[:-1].tolist(), first[1:].tolist())]
                yield pa.RecordBatch.from_arrays([batch.column("item_id").slice(a, b - a), pa.array(rows, pa.list_(pa.int64()))], names=["item_id", "terms"])

    kind = dict(items.dtypes)["item_id"]
    rows = items.select("item_id", "text").mapInArrow(read, f"item_id {kind}, terms array<bigint>").where(F.size("terms") > 0)
    rows = kept(rows.withColumn("part", F.xxhash64(F.monotonically_increasing_id())))
    total = rows.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-total // BLOCK_TERMS)
    for block in range(blocks):
        found = rows.where(F.pmod("part", F.lit(blocks)) == block).select("item_id", "terms").collect()
        if not found:
            continue
        each = [np.unique(np.array(r.terms, dtype=np.int64).view(np.uint64), return_counts=True) for r in found]
        vocabulary = np.unique(np.concatenate([t for t, _ in each]))
        yield Items(
            [r.item_id for r in found],
            vocabulary,
            np.cumsum([0, *[len(t) for t, _ in each]]),
            np.concatenate([np.searchsorted(vocabulary, t) for t, _ in each]),
            np.concatenate([c for _, c in each]).astype(np.int64),
        )


def term_counts(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, term, tf) per document with a term: its terms in all, and packed numbers and counts of those in ``vocabulary``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.uint64(len(vocabulary))
        for batch in batches:
            data, offsets = raw(batch.column("text"))
            for a, b in slices(offsets):
                hashes, first = terms_of(data, offsets[a : b + 1])
                n = np.diff(first)
                place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                asked = np.flatnonzero(vocabulary[place] == hashes)
                row = np.repeat(np.arange(b - a, dtype=np.uint64), n)[asked]
                key, tf = np.unique(row * size + place[asked].astype(np.uint64), return_counts=True)
                term, tf = (key % size).astype(np.int32), tf.astype(np.int32)
                cut = np.searchsorted(key // size, np.arange(b - a + 1, dtype=np.uint64))
                full = np.flatnonzero(n > 0)
                bounds = list(zip(cut[full].tolist(), cut[full + 1].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a).take(pa.array(full)),
                        pa.array(n[full], pa.int64()),
                        pa.array([term[x:y].tobytes() for x, y in bounds], pa.binary()),
                        pa.array([tf[x:y].tobytes() for x, y in bounds], pa.binary()),
                    ],
                    names=["doc_id", "n", "term", "tf"],
                )

    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return docs.mapInArrow(run, "doc_id bigint, n bigint, term binary, tf binary")


def document_frequencies(counts: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            terms = np.frombuffer(b"".join(batch.column("term").to_pylist()), dtype=np.int32)
            total += np.bincount(terms, minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["term", "df"])

    found = counts.select("term").mapInArrow(run, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(size, dtype=np.int64)
    out[found.column("term").to_numpy()] = found.column("df").to_numpy()
    return out


@dataclass
class Weights:
    """What turns counts into weights: the documents with a term, all their terms, and a weight per term."""

    documents: int
    terms: int
    idf: np.ndarray

    def entries(self, term: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The weight of each term in a document of ``n`` terms, in 64-bit integers."""
        m = 100 - 75 + (75 * n * self.documents) // self.terms
        return self.idf[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def weights(counts: DataFrame, size: int) -> Weights:
    documents, terms = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    ratio = (2 * documents + 2) / (2 * document_frequencies(counts, size) + 1)
    return Weights(documents, max(terms, 1), np.floor(1000 * np.log(ratio)).astype(np.int64))


# ---- ball trees -----------------------------------------------------------------------------------------------


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between the places of ``first``; rows may be empty."""
    total = np.zeros(len(first) - 1, dtype=values.dtype)
    some = np.flatnonzero(first[1:] > first[:-1])
    if len(some):
        total[some] = np.add.reduceat(values, first[some])[: len(some)]
    return total


@dataclass
class Ball:
    """A node: its documents are rows ``begin`` to ``end`` of the tree; ``bounds`` holds one score per item."""

    begin: int
    end: int
    bounds: np.ndarray
    children: list[Ball] = field(default_factory=list)


@dataclass
class Tree:
    """Documents as rows of a sparse matrix, in the order of the leaves, and the root over them."""

    ids: np.ndarray
    first: np.ndarray
    term: np.ndarray
    weight: np.ndarray
    root: Ball


def taken(first: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The places of the entries of some rows."""
    size = first[rows + 1] - first[rows]
    start = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(first[rows] - start, size)


def grown(ids: np.ndarray, first: np.ndarray, term: np.ndarray, weight: np.ndarray, items: Items) -> Tree:
    """A ball tree over some documents.  A node is cut between the documents nearer to one of two distant documents and the
    others, or in halves along that line where one side would have less than one in ``SLIMMEST``."""
    size = len(items.vocabulary)
    value = weight.astype(np.float64)
    squares = row_sums(value * value, first)
    item_norm = np.sqrt(row_sums(items.count.astype(np.float64) ** 2, items.first))
    order = np.arange(len(ids))

    def ball(begin: int, end: int) -> Ball:
        rows = order[begin:end]
        at = taken(first, rows)
        own_term, own_value = term[at], value[at]
        starts = np.append(0, np.cumsum(first[rows + 1] - first[rows]))
        centroid = np.bincount(own_term, own_value, minlength=size) / len(rows)
        inside = float(centroid @ centroid)

        def distances(point: np.ndarray, square: float) -> np.ndarray:
            return squares[rows] - 2 * row_sums(own_value * point[own_term], starts) + square

        away = distances(centroid, inside)
        # every sum above is of at most ``size`` terms and none is larger than what both squares add up to
        slack = 8 * (size + 8) * _EPS * (float(squares[rows].max()) + inside)
        radius = float(np.sqrt(max(float(away.max()), 0.0) + slack))
        dots = row_sums(items.count * centroid[items.term], items.first)
        bounds = (dots + item_norm * radius) * (1 + 8 * (size + 8) * _EPS) + 1
        node = Ball(begin, end, bounds)
        if len(rows) > LEAF:
            def spread(row: int) -> tuple[np.ndarray, float]:
                point = np.zeros(size)
                point[own_term[starts[row] : starts[row + 1]]] = own_value[starts[row] : starts[row + 1]]
                return point, float(squares[rows[row]])

            one, square = spread(int(away.argmax()))
            from_one = distances(one, square)
            other, square = spread(int(from_one.argmax()))
            side = from_one - distances(other, square)
            cut = int((side < 0).sum())
            if min(cut, len(rows) - cut) < len(rows) // SLIMMEST:
                cut = len(rows) // 2
            order[begin:end] = rows[np.argpartition(side, cut)]
            node.children = [ball(begin, begin + cut), ball(begin + cut, end)]
        return node

    root = ball(0, len(ids))
    at = taken(first, order)
    return Tree(ids[order], np.append(0, np.cumsum(first[order + 1] - first[order])), term[at], weight[at], root)


class Best:
    """The ``k`` best (score, document) pairs per item so far: highest scores first, equal ones by ascending document."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(items)]

    def least(self, item: int) -> int:
        """A score below this can't matter any more."""
        heap = self.heaps[item]
        return heap[0][0] if len(heap) == self.k else 1

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        heap, least = self.heaps[item], self.least(item)
        for i in np.flatnonzero(scores >= least).tolist():
            entry = (int(scores[i]), -int(ids[i]))
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)


def search(tree: Tree, items: Items, best: Best) -> int:
    """Bring ``best`` up to date with the documents of a tree; gives the number of leaves that were opened."""
    size, opened = len(items.vocabulary), 0
    asked = np.zeros(size, dtype=np.int64)
    for item in range(len(items.ids)):
        terms = items.term[items.first[item] : items.first[item + 1]]
        asked[terms] = items.count[items.first[item] : items.first[item + 1]]
        front, tick = [(-tree.root.bounds[item], 0, tree.root)], 0
        while front:
            bound, _, node = heapq.heappop(front)
            if -bound < best.least(item):
                break  # all others are lower still
            if node.children:
                for child in node.children:
                    if child.bounds[item] >= best.least(item):
                        tick += 1
                        heapq.heappush(front, (-child.bounds[item], tick, child))
                continue
            opened += 1
            low, high = tree.first[node.begin], tree.first[node.end]
            each = tree.weight[low:high] * asked[tree.term[low:high]]
            best.add(item, row_sums(each, tree.first[node.begin : node.end + 1] - low), tree.ids[node.begin : node.end])
        asked[terms] = 0
    return opened


# ---- the operator ---------------------------------------------------------------------------------------------


def _ranked_block(counts: DataFrame, items: Items, found: Weights, k: int) -> DataFrame:
    """(item, score, doc_id): at most ``k`` documents per item and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, waiting, docs, entries = Best(len(items.ids), k), [], 0, 0

        def plant() -> None:
            ids = np.concatenate([w[0] for w in waiting])
            size = np.concatenate([w[1] for w in waiting])
            term, tf, n = (np.concatenate([w[i] for w in waiting]) for i in (2, 3, 4))
            weight = found.entries(term, tf, np.repeat(n, size))
            search(grown(ids, np.append(0, np.cumsum(size)), term, weight, items), items, best)

        for batch in batches:
            for a in range(0, batch.num_rows, TREE_DOCS // 8):
                part = batch.slice(a, TREE_DOCS // 8)
                terms, tfs = part.column("term").to_pylist(), part.column("tf").to_pylist()
                size = np.array([len(t) // 4 for t in terms], dtype=np.int64)
                term, tf = (np.frombuffer(b"".join(x), dtype=np.int32).astype(np.int64) for x in (terms, tfs))
                waiting.append((part.column("doc_id").to_numpy(), size, term, tf, part.column("n").to_numpy()))
                docs, entries = docs + len(size), entries + int(size.sum())
                if docs >= TREE_DOCS or entries >= TREE_ENTRIES:
                    plant()
                    waiting, docs, entries = [], 0, 0
        if docs:
            plant()
        rows = [(i, score, -doc) for i, heap in enumerate(best.heaps) for score, doc in heap]
        item, score, doc = ([r[j] for r in rows] for j in range(3))
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(score, pa.int64()), pa.array(doc, pa.int64())], names=["item", "score", "doc_id"])

    asked = counts.where(F.col("doc_id").isNotNull() & (F.length("term") > 0))
    return asked.mapInArrow(run, "item int, score bigint, doc_id bigint")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring documents of each item, with scores above 0.

    ``docs`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``; other columns are ignored.  Equal scores are
    ranked by ascending document.  Null and empty texts have no terms: such documents count nowhere, such items get no
    rows.  Documents without an id count in all statistics but aren't ranked.  Repeated documents are ranked one by one, and
    repeated items get their rows each.  Empty tables give no rows.
    """
    docs = docs.select("doc_id", "text")
    session, kind = docs.sparkSession, dict(items.dtypes)["item_id"]
    out = None
    for block in item_blocks(items):
        counts = kept(term_counts(docs, block.vocabulary))
        found = _ranked_block(counts, block, weights(counts, len(block.vocabulary)), k)
        place = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
        top = found.withColumn("rank", place).where(F.col("rank") <= k)
        names = session.createDataFrame(list(enumerate(block.ids)), f"item int, item_id {kind}")
        rows = kept(top.join(names, "item").select("item_id", "rank", "doc_id", "score"))
        out = rows if out is None else out.unionByName(rows)
    return session.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint") if out is None else out
