"""Logistic models fitted side by side, and exactly.

A fit weighs the summed loss with ``C`` against the penalty and leaves the intercept free.  All models of a search, one per
strength and left-out fold, take their Newton steps together: a step is one pass over the rows, in which every task sums
loss, gradient and curvature of every model.  What comes back is one row per model, of the square of the number of features.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 4096
ROUNDING = 1e-14


@dataclass(frozen=True)
class Setting:
    """A strength, and the fold whose rows are left out (none: all rows are used)."""

    C: float
    fold: int | None = None


@dataclass
class LogisticModel:
    """Weights of a fitted model."""

    coefficients: DenseVector
    intercept: float

    def logit(self, features: Column) -> Column:
        weights = F.array(*[F.lit(float(w)) for w in self.coefficients.toArray()]).cast("array<double>")
        parts = F.zip_with(vector_to_array(features), weights, lambda x, w: x * w)
        return F.aggregate(parts, F.lit(float(self.intercept)), lambda s, v: s + v)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the probabilities of both classes."""
        chance = 1 / (1 + F.exp(-self.logit(F.col("features"))))
        return df.withColumn("probability", array_to_vector(F.array(1 - chance, chance)))


@dataclass
class Sums:
    """Loss, rows, positives, gradient and curvature of one model; the intercept is the last entry."""

    loss: float
    rows: float
    positives: float
    gradient: np.ndarray
    curvature: np.ndarray


def _parts(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """What the rows of a block add to the sums of one model."""
    z = x @ weights
    chance = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
    loss = (np.maximum(z, 0) - z * y + np.log1p(np.exp(-np.abs(z)))).sum()
    curvature = (x * (chance * (1 - chance))[:, None]).T @ x
    return np.concatenate([[loss, len(y), y.sum()], x.T @ (chance - y), curvature.ravel()])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows with a one at the end, labels and folds."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            lists = part.column("x")
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
            yield np.hstack([x, np.ones((len(x), 1))]), part.column("y").to_numpy(), part.column("fold").to_numpy()


def sums(rows: DataFrame, models: Sequence[tuple[int, int, np.ndarray]], width: int) -> dict[int, Sums]:
    """The sums of each (number, left-out fold or -1, weights), by number, in one pass over (x, y, fold)."""
    entries = 3 + width + width * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(models), entries))
        for x, y, fold in _blocks(batches):
            for k, (_, left_out, weights) in enumerate(models):
                use = fold != left_out
                total[k] += _parts(x[use], y[use], weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array([number for number, *_ in models], pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["model", "v"]
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, v in zip(batch.column("model").to_pylist(), batch.column("v")):
                part = v.values.to_numpy()
                found[number] = found[number] + part if number in found else part.copy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.list_(pa.float64()))], names=["model", "v"]
        )

    schema = "model int, v array<double>"
    partial = rows.mapInArrow(run, schema)
    out = {}
    for r in partial.repartition("model").mapInArrow(add, schema).collect():  # a row per model
        v = np.array(r.v)
        out[r.model] = Sums(*v[:3], v[3 : 3 + width], v[3 + width :].reshape(width, width))
    return out


def _step(found: Sums, weights: np.ndarray, strength: float, penalty: str) -> tuple[np.ndarray, float]:
    """The Newton step of a model, and how far its weights are from the optimum (largest entry of the subgradient)."""
    inner = np.append(np.ones(len(weights) - 1), 0.0) * strength
    curvature = found.curvature + 1e-12 * max(found.rows, 1) * np.eye(len(weights))
    if penalty == "l2":
        gradient = found.gradient + inner * weights
        return -np.linalg.solve(curvature + np.diag(inner), gradient), float(np.abs(gradient).max())
    pull = found.gradient + inner * np.sign(weights)
    slack = np.where(weights != 0, np.abs(pull), np.maximum(np.abs(found.gradient) - inner, 0))
    # the penalised quadratic model, minimised one weight at a time
    new, slope = weights.copy(), found.gradient.copy()
    while True:
        moved = 0.0
        for j in range(len(new)):
            free = new[j] - slope[j] / curvature[j, j]
            best = np.sign(free) * max(abs(free) - inner[j] / curvature[j, j], 0.0)
            if best != new[j]:
                slope += curvature[:, j] * (best - new[j])
                moved = max(moved, abs(best - new[j]) / (1 + abs(best)))
                new[j] = best
        if moved < ROUNDING:
            return new - weights, float(slack.max())


def objective(found: Sums, weights: np.ndarray, strength: float, penalty: str) -> float:
    inner = weights[:-1]
    return found.loss + strength * (float(inner @ inner) / 2 if penalty == "l2" else float(np.abs(inner).sum()))


def fit_many(
    df: DataFrame, settings: Sequence[Setting], label: str = "label", penalty: str = "l2", max_iter: int = 1000, tol: float = 1e-10
) -> list[LogisticModel]:
    """A model per setting, in their order, from ``features``, the 0/1 label and (if a setting leaves one out) ``fold``.

    A model is done when no entry of its subgradient is above ``tol`` per row, when steps no longer lower its objective
    beyond rounding, or after ``max_iter`` passes.  Rows with a missing label are left out.  A model that sees one class only
    always names that class; one without any rows is undecided.
    """
    fold = F.col("fold").cast("int") if "fold" in df.columns else F.lit(None).cast("int")
    rows = df.where(F.col(label).isNotNull()).select(
        vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"), F.coalesce(fold, F.lit(-2)).alias("fold")
    )
    first = rows.select(F.size("x")).first()
    width = (first[0] if first else 0) + 1
    weights = [np.zeros(width) for _ in settings]
    last: list[tuple[float, np.ndarray]] = [(np.inf, w) for w in weights]
    open_models = list(range(len(settings) if first else 0))
    for _ in range(max_iter):
        if not open_models:
            break
        asked = [(k, -1 if settings[k].fold is None else settings[k].fold, weights[k]) for k in open_models]
        found = sums(rows, asked, width)
        for k in list(open_models):
            s, strength = found[k], 1.0 / settings[k].C
            if s.positives in (0, s.rows):
                side = 0.0 if not s.rows else np.inf if s.positives else -np.inf
                weights[k] = np.append(np.zeros(width - 1), side)
                open_models.remove(k)
                continue
            value = objective(s, weights[k], strength, penalty)
            lowest, best = last[k]
            if value > lowest + ROUNDING * abs(lowest):  # too long a step: back half the way
                if np.abs(weights[k] - best).max() <= ROUNDING * (1 + np.abs(best).max()):
                    weights[k] = best
                    open_models.remove(k)
                else:
                    weights[k] = (weights[k] + best) / 2
                continue
            last[k] = (value, weights[k])
            step, away = _step(s, weights[k], strength, penalty)
            if away <= tol * s.rows or np.abs(step).max() <= ROUNDING * (1 + np.abs(weights[k]).max()):
                open_models.remove(k)
            else:
                weights[k] = weights[k] + step
    return [LogisticModel(Vectors.dense(w[:-1]), float(w[-1])) for w in weights]


def scored_out(df: DataFrame, settings: Sequence[Setting], models: Sequence[LogisticModel], label: str = "label") -> DataFrame:
    """(C, fold, label, score): every row of ``df`` by the models that its fold was left out of."""
    by_fold: dict[int, list[tuple[float, np.ndarray]]] = {}
    for s, m in zip(settings, models):
        by_fold.setdefault(s.fold, []).append((s.C, np.append(m.coefficients.toArray(), m.intercept)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y, fold in _blocks(batches):
            for f in np.unique(fold):
                here = fold == f
                for strength, weights in by_fold.get(int(f), []):
                    z = x[here] @ weights
                    columns = [np.full(len(z), strength), np.full(len(z), f, dtype=np.int32), y[here].astype(np.int32), 1 / (1 + np.exp(-z))]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["C", "fold", "label", "score"])

    rows = df.where(F.col(label).isNotNull()).select(
        vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"), F.col("fold").cast("int").alias("fold")
    )
    return rows.mapInArrow(run, "C double, fold int, label int, score double")
