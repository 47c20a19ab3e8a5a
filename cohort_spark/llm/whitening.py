"""Whitening of embeddings by a matrix-free block Jacobi-Davidson method.

A vector becomes integers, and the fit list holds each distinct integer vector once.  Its covariance is never formed: the
only thing asked of the data is the product of the covariance with a block of a few columns, one pass over the fit list in
which every task centres its rows exactly (``n * x - S`` in integers) before it multiplies.

The driver holds the search space, a few columns of one entry per dimension.  A step takes the Ritz pairs of the largest
values, locks the leading ones whose residuals are at double precision, solves the projected correction equation of every
other pair by a few steps of MINRES (all pairs share each pass), and adds the corrections to the space.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.llm.store import kept

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
GUARD = 4
INNER_STEPS = 4
INNER_GAIN = 0.02
ROUNDING = 64 * np.finfo(float).eps
STALLED = 1e-11
ZERO = 1e-12
BLOCK_ROWS = 4096
PART_BYTES = 64 << 20
FAN = 256
Product = Callable[[np.ndarray], np.ndarray]


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, x, entries): entries as ``floor(64 * c) + 1000000`` packed into bytes, without rows that hold a null, NaN or
    infinity."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = vectors.where(v.isNotNull() & finite)
    whole = usable.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(v, lambda c: F.floor(c * SCALE) + SHIFT).alias("v"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v").cast(pa.large_list(pa.int64()))
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            rows = [values[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            entries = pa.array(np.diff(offsets).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(rows, pa.binary()), entries], names=["vec_id", "x", "entries"])

    return whole.mapInArrow(packed, "vec_id bigint, x binary, entries int")


def filled(vectors: DataFrame, size: int) -> DataFrame:
    """Shorter vectors filled up with the integers of zeros."""
    zeros = (np.full(size, SHIFT, dtype=np.int64)).tobytes()
    full = F.expr(f"substring(concat(x, X'{zeros.hex()}'), 1, {8 * size})")
    return vectors.select("vec_id", F.when(F.col("entries") == size, F.col("x")).otherwise(full).alias("x"))


@dataclass
class FitList:
    """The distinct vectors and what centres them."""

    rows: DataFrame
    parts: int
    size: int
    n: int
    sums: np.ndarray

    def summed(self, part: Callable[[np.ndarray], np.ndarray], entries: int) -> np.ndarray:
        """The sum over all rows of ``part(centred rows / n)``, an array of ``entries`` doubles."""
        size, n, sums = self.size, self.n, self.sums

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, lost = np.zeros(entries), np.zeros(entries)
            for x in blocks(batches, size):
                more = part((n * x - sums) / n).ravel()  # centred exactly, then divided
                now = total + more
                back = now - total
                lost += (total - (now - back)) + (more - back)  # what the addition rounded away
                total = now
            yield pa.RecordBatch.from_arrays([pa.array([total + lost], pa.list_(pa.float64()))], names=["v"])

        return added(self.rows.mapInArrow(run, "v array<double>"), self.parts, pa.float64(), entries)

    def covariance_times(self, u: np.ndarray) -> np.ndarray:
        """The covariance times the columns of ``u``."""
        return self.summed(lambda c: c.T @ (c @ u), u.size).reshape(u.shape) / self.n


def added(partial: DataFrame, parts: int, kind: pa.DataType, entries: int) -> np.ndarray:
    """The sum of the arrays ``v`` of ``entries`` numbers, at most ``FAN`` of which meet in a task at a time."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for v in batch.column("v"):
                values = v.values.to_numpy()
                total = values.copy() if total is None else total + values
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(kind))], names=["v"])

    while parts > 1:
        parts = -(-parts // FAN)
        partial = partial.repartition(parts).mapInArrow(add, partial.schema)
    rows = partial.collect()  # one row
    return np.array(rows[0].v) if rows else np.zeros(entries, dtype=kind.to_pandas_dtype())


def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[np.ndarray]:
    """The packed vectors of a task as matrices of a bounded number of rows."""
    for batch in batches:
        for a in range(0, batch.num_rows, BLOCK_ROWS):
            column = batch.column("x").slice(a, BLOCK_ROWS)
            yield np.frombuffer(b"".join(column.to_pylist()), dtype=np.int64).reshape(len(column), size)


def fit_list(vectors: DataFrame, size: int) -> FitList:
    """The distinct vectors of ``vectors`` (x), their number and their sums per dimension."""
    distinct = kept(vectors.select("x").distinct())
    context = vectors.sparkSession.sparkContext
    parts = max(context.defaultParallelism, -(-distinct.count() * 8 * size // PART_BYTES))
    rows = kept(distinct.coalesce(parts))  # many passes over tasks of a useful size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(size, dtype=np.int64), 0
        for x in blocks(batches, size):
            total, n = total + x.sum(axis=0), n + len(x)
        yield pa.RecordBatch.from_arrays([pa.array([[n, *total.tolist()]], pa.list_(pa.int64()))], names=["v"])

    parts = rows.rdd.getNumPartitions()
    n, *sums = added(rows.mapInArrow(run, "v array<bigint>"), parts, pa.int64(), size + 1).tolist()
    return FitList(rows, parts, size, n, np.array(sums, dtype=np.int64))


# ---- Jacobi-Davidson ------------------------------------------------------------------------------------------


def orthonormal(new: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Orthonormal columns for what ``new`` adds to the span of ``against``."""
    out = np.zeros((len(new), 0))
    for column in new.T:
        length = np.linalg.norm(column)
        for _ in range(3):
            for base in (against, out):
                column = column - base @ (base.T @ column)
        left = np.linalg.norm(column)
        if left > 1e-10 * length and left > 0:
            column = column / left
            for base in (against, out):
                column = column - base @ (base.T @ column)
            out = np.column_stack([out, column / np.linalg.norm(column)])
    return out


def corrections(product: Product, values: np.ndarray, residuals: np.ndarray, outside: list[np.ndarray]) -> np.ndarray:
    """MINRES on ``(I - QQ')(A - value I)(I - QQ') t = -residual`` for each pair, ``Q`` being its columns of ``outside``.

    The Lanczos steps of all pairs share one product each.  A pair is left as it is once its equation's residual has
    fallen to ``INNER_GAIN`` of what it was.
    """

    def projected(block: np.ndarray) -> np.ndarray:
        return np.column_stack([c - q @ (q.T @ c) for c, q in zip(block.T, outside)])

    right = projected(-residuals)
    beta = np.linalg.norm(right, axis=0)
    start, k = beta.copy(), len(values)
    v_old, v = np.zeros_like(right), right / np.where(beta > 0, beta, 1)
    t, w_old, w = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    cosine_old, sine_old, cosine, sine = np.ones(k), np.zeros(k), np.ones(k), np.zeros(k)
    left, beta = beta.copy(), np.zeros(k)
    going = start > 0
    for _ in range(INNER_STEPS):
        if not going.any():
            break
        at = np.flatnonzero(going)
        az = np.zeros_like(v)
        az[:, at] = product(v[:, at])
        az = projected(az - v * values)
        alpha = (v * az).sum(axis=0)
        v_new = projected(az - v * alpha - v_old * beta)
        beta_new = np.linalg.norm(v_new, axis=0)
        # the two earlier rotations, then a new one that removes the entry below the diagonal
        above = sine_old * beta
        middle = cosine * cosine_old * beta + sine * alpha
        raw = cosine * alpha - sine * cosine_old * beta
        length = np.hypot(raw, beta_new)
        safe = np.where(length > 0, length, 1)
        cosine_new, sine_new = raw / safe, beta_new / safe
        w_new = (v - w * middle - w_old * above) / safe
        step = np.where(going & (length > 0), cosine_new * left, 0)
        t = t + w_new * step
        left = np.where(going, -sine_new * left, left)
        going = going & (np.abs(left) > INNER_GAIN * start) & (beta_new > 1e-14 * np.abs(alpha))
        v_old, v = v, v_new / np.where(beta_new > 0, beta_new, 1)
        w_old, w, beta = w, w_new, beta_new
        cosine_old, sine_old, cosine, sine = cosine, sine, cosine_new, sine_new
    return projected(t)


def largest(product: Product, size: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric positive semidefinite operator, falling, and unit eigenvectors as
    columns, with residuals at double precision of the largest value.

    Locked pairs stay in the space: they keep others from finding them again, and the last Rayleigh-Ritz step is over all.
    A pair whose residual no longer falls counts as locked only below ``STALLED`` of the largest value, where what is left
    is the rounding of the sums themselves.
    """
    width = min(size, wanted + GUARD)
    most = max(4 * width, width + 8)
    space = orthonormal(np.random.default_rng(20250501).standard_normal((size, width)), np.zeros((size, 0)))
    images = product(space)
    before = np.full(wanted, np.inf)
    while True:
        small = space.T @ images
        theta, rotation = np.linalg.eigh((small + small.T) / 2)
        theta, rotation = theta[::-1], rotation[:, ::-1]
        keep = min(width, space.shape[1])
        vectors, over = space @ rotation[:, :keep], images @ rotation[:, :keep]
        residuals = over - vectors * theta[:keep]
        norms, largest_value = np.linalg.norm(residuals, axis=0), max(abs(float(theta[0])), np.finfo(float).tiny)
        now = norms[:wanted] / largest_value
        fine = (now <= ROUNDING) | ((now <= STALLED) & (now > 0.5 * before))
        before = now
        locked = int(np.argmin(np.append(fine, False)))  # leading pairs only, so none is locked before a larger one
        if locked == wanted:
            return theta[:wanted], vectors[:, :wanted]
        if space.shape[1] == size:
            space = vectors if keep == size else orthonormal(space, np.zeros((size, 0)))  # everything is spanned: only rounding is left
            images = product(space)
            small = space.T @ images
            theta, rotation = np.linalg.eigh((small + small.T) / 2)
            return theta[::-1][:wanted], (space @ rotation[:, ::-1])[:, :wanted]
        if space.shape[1] + keep - locked > most:  # restart with the best half
            half = min(space.shape[1], 2 * width)
            space, images = space @ rotation[:, :half], images @ rotation[:, :half]
            tidy, upper = np.linalg.qr(space)
            space, images = tidy, images @ np.linalg.inv(upper)
        open_pairs = range(locked, keep)
        outside = [np.column_stack([vectors[:, :locked], vectors[:, j]]) for j in open_pairs]
        found = corrections(product, theta[locked:keep], residuals[:, locked:keep], outside)
        new = orthonormal(found, space)
        if not new.shape[1]:  # no correction leads out of the space: go on from fresh directions
            new = orthonormal(np.random.default_rng(space.shape[1]).standard_normal((size, min(width, size - space.shape[1]))), space)
        space, images = np.column_stack([space, new]), np.column_stack([images, product(new)])


# ---- the operator ---------------------------------------------------------------------------------------------


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every row with a usable vector and every
    component.

    ``vectors`` has ``vec_id`` and ``embedding``; other columns are ignored.  Rows whose vector is null or holds a null, NaN or
    infinity are left out.  Shorter vectors are filled up with zeros.  Repeated vectors count once in the fit and get a row
    each; a null id stays null.  Components whose eigenvalue is zero to double precision can't be whitened and are left out,
    so equal vectors, a single vector or an empty table give no rows.  ``deviation`` is exact; one beyond a long is an error.
    """
    packed = kept(integer_vectors(vectors))
    size = packed.agg(F.max("entries")).first()[0] or 0
    out = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if not size:
        return packed.sparkSession.createDataFrame([], out)
    rows = filled(packed, size)
    fit = fit_list(rows, size)
    values, axes = largest(fit.covariance_times, size, min(components, size))
    k = len(values)
    moments = fit.summed(lambda c: np.concatenate([[(c * c).sum()], (c @ axes).sum(axis=0), ((c @ axes).T @ (c @ axes)).ravel()]), 1 + k + k * k) / fit.n
    trace, mean, second = float(moments[0]), moments[1 : k + 1], moments[k + 1 :].reshape(k, k)
    usable = int((values > ZERO * max(trace, np.finfo(float).tiny)).sum())
    if not usable:
        return packed.sparkSession.createDataFrame([], out)
    values, axes = values[:usable], axes[:, :usable] / np.sqrt(values[:usable])
    covariance = (second - np.outer(mean, mean))[:usable, :usable] / np.sqrt(np.outer(values, values))
    error = float(np.abs(covariance - np.eye(usable)).max())
    explained, n, sums = values / trace, fit.n, fit.sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, x in enumerate(blocks(iter([batch]), size)):
                ids = batch.column("vec_id").slice(k * BLOCK_ROWS, BLOCK_ROWS)
                c = n * x - sums
                limit = float((c.astype(np.float64) ** 2).sum(axis=1).max())
                if limit >= 9.2e18:
                    raise OverflowError("a deviation is larger than a long can hold")
                m = len(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(np.repeat(np.arange(m), usable))),
                        pa.array(np.tile(np.arange(1, usable + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * usable, n, dtype=np.int64)),
                        pa.array(np.repeat((c * c).sum(axis=1), usable)),
                        pa.array(((c / n) @ axes).ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * usable, error)),
                    ],
                    names=[f.split()[0] for f in out.split(", ")],
                )

    return rows.mapInArrow(run, out)
