"""Exact top-k inner products by a three-phase uniform threshold.

A vector is cut into ``LISTS`` ranges of components; for a query each range gives a list of partial scores over all
vectors.  1. Every task gathers, per query and list, its entries with the largest partial scores, and hands on their
full scores.  2. The k-th best of those is a safe cutoff for the query: it is sent to all tasks, and an entry can only
reach it if one of its partial scores is at least ``cutoff / LISTS``; such entries are collected.  3. Their remaining
partial scores are resolved, and those that reach the cutoff compete for the result.

Queries are handled in blocks of a fixed number of rows, so what a task holds of them is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohort_spark.llm.store import kept

LISTS = 2
QUERY_BLOCK = 2048
ROW_BLOCK = 4096
_EXACT = float(1 << 53)
_SCORED = "query_id bigint, vec_id bigint, score bigint"


def integer_vectors(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, v): every component as ``floor(scale * x)``; rows that hold a null, NaN or infinity are left out."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.where(F.col("vec_id").isNotNull() & v.isNotNull() & finite)
    return usable.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(v, lambda x: F.floor(x * scale)).alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of integers, shorter ones filled with zeros."""
    column = column.cast(pa.large_list(pa.int64()))
    n = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(n), int(n.max()) if len(n) else 0), dtype=np.int64)
    out[np.arange(out.shape[1])[None, :] < n[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` over the components both have, exactly: in floating point where every sum fits into 53 bits."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = [float(np.abs(x.astype(np.float64)).max()) if x.size else 0.0 for x in (a, b)]
    if most[0] * most[1] * width < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best entries of a list, the smaller id first among equal scores."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        above, level = np.flatnonzero(score > least), np.flatnonzero(score == least)
        level = level[np.argsort(ids[level], kind="stable")[: k - len(above)]]
        return np.concatenate([above, level])
    return np.arange(len(score))


def _ranges(width: int) -> list[slice]:
    edges = np.linspace(0, width, LISTS + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROW_BLOCK):
            part = batch.slice(at, ROW_BLOCK)
            yield part.column("vec_id").to_numpy(), _matrix(part.column("v"))


class _Kept:
    """Per query the best entries of a task so far: at most ``k`` each."""

    def __init__(self, k: int, n: int):
        self.k = k
        self.ids = [np.zeros(0, np.int64)] * n
        self.scores = [np.zeros(0, np.int64)] * n

    def add(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids[q], ids]), np.concatenate([self.scores[q], scores])
        best = _best(scores, ids, self.k)
        self.ids[q], self.scores[q] = ids[best], scores[best]

    def batch(self, names: np.ndarray) -> pa.RecordBatch:
        lengths = [len(x) for x in self.ids]
        columns = [np.repeat(names, lengths), np.concatenate([np.zeros(0, np.int64), *self.ids]), np.concatenate([np.zeros(0, np.int64), *self.scores])]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])


def _gather(names: np.ndarray, queries: np.ndarray, k: int):
    """Phase 1: full scores of the entries that lead a local list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Kept(k, len(names))
        for ids, rows in _rows(batches):
            parts = [_times(queries[:, r], rows[:, r]) for r in _ranges(max(queries.shape[1], rows.shape[1]))]
            full = sum(parts)
            for q, name in enumerate(names):
                other = np.flatnonzero(ids != name)
                lead = np.unique(np.concatenate([other[_best(p[q, other], ids[other], k)] for p in parts]))
                found.add(q, ids[lead], full[q, lead])
        yield found.batch(names)

    return run


def _collect(names: np.ndarray, queries: np.ndarray, cutoff: np.ndarray, k: int):
    """Phases 2 and 3: entries with a partial score of cutoff / LISTS or more, resolved, that reach the cutoff."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Kept(k, len(names))
        share = np.floor_divide(cutoff, LISTS)
        for ids, rows in _rows(batches):
            ranges = _ranges(max(queries.shape[1], rows.shape[1]))
            parts = [_times(queries[:, r], rows[:, r]) for r in ranges]
            open_ = np.logical_or.reduce([p >= share[:, None] for p in parts])
            for q, name in enumerate(names):
                enough = np.flatnonzero(open_[q] & (ids != name))
                score = sum(p[q, enough] for p in parts)
                reach = score >= cutoff[q]
                found.add(q, ids[enough[reach]], score[reach])
        yield found.batch(names)

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors`` (vec_id, embedding) that ``is_query`` holds for, the
    ``k`` other rows with the largest integer inner product, ties to the smaller ``vec_id``; all if there are fewer.

    Null vectors, vectors with null or non-finite components and rows without an id take no part.  Vectors of
    different length meet in the components both have; scores must fit into 64 bits.  A repeated row is as many candidates; repeated query rows
    ask once, with the vector that sorts first.  An empty table or no query gives no rows.
    """
    ints = kept(integer_vectors(vectors, scale))
    asked = kept(ints.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")))
    total = asked.count()
    blocks = -(-total // QUERY_BLOCK)
    numbered = asked.withColumn("__block", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, 2 * blocks if blocks > 1 else 1))))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    results = ints.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    for block in range(max(1, 2 * blocks if blocks > 1 else 1) if total else 0):
        table = numbered.where(F.col("__block") == block).select("vec_id", "v").toArrow().combine_chunks()
        if not table.num_rows:
            continue
        names, queries = table.column("vec_id").to_numpy(), _matrix(table.column("v").combine_chunks())
        gathered = ints.mapInArrow(_gather(names, queries, k), _SCORED)
        level = gathered.withColumn("__at", F.row_number().over(order)).where(F.col("__at") == k).select("query_id", "score")
        cutoff = dict(level.collect())  # one number per query of the block
        safe = np.array([cutoff.get(int(q), -(1 << 62)) for q in names], dtype=np.int64)
        collected = ints.mapInArrow(_collect(names, queries, safe, k), _SCORED)
        ranked = collected.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        results = results.unionByName(ranked.select("query_id", "rank", "vec_id", "score"))
    return results
