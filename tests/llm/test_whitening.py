import numpy as np
import pytest

from cohort_spark.llm import whitening
from cohort_spark.llm.queries import QUERIES
from cohort_spark.llm.whitening import largest, whiten
from tests.llm.conftest import FOLDER

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(rows):
    """n, sums, eigenvalues (falling), and the integer vectors of (id, vector) rows with usable vectors."""
    usable = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    size = max((len(v) for _, v in usable), default=0)
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] + [1_000_000] * (size - len(v)) for _, v in usable]
    fit = np.array(sorted(set(map(tuple, x))), dtype=np.int64).reshape(-1, size)
    n, sums = len(fit), fit.sum(axis=0)
    c = (n * fit - sums) / max(n, 1)
    covariance = c.T @ c / max(n, 1)
    return usable, x, n, sums, covariance


def check(rows, result, at_most=16):
    usable, x, n, sums, covariance = brute(rows)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(at_most, int((values > 1e-12 * values.sum()).sum()))
    found = result.collect()
    assert len(found) == len(usable) * k
    sums = [int(s) for s in sums]
    by = {}
    for r in found:
        by.setdefault((r.vec_id, r.deviation), []).append(r)
        assert r.n == n and r.identity_error <= 1e-4
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-10)
    want = {}
    for (i, _), v in zip(usable, x):
        want.setdefault((i, sum((n * a - s) ** 2 for a, s in zip(v, sums))), []).append(v)
    assert {k: len(v) for k, v in by.items()} == {key: len(v) * k for key, v in want.items()}
    got = np.array([[r.whitened for r in sorted(by[key], key=lambda r: r.component)][:: len(vs)] for key, vs in want.items()])
    plain = np.array([[(n * a - s) / n for a, s in zip(vs[0], sums)] for vs in want.values()]) @ vectors[:, :k] / np.sqrt(values[:k])
    gaps = np.abs(np.diff(values))
    for j in range(k):  # either sign; a component that shares its eigenvalue has no axis of its own
        if min(gaps[max(j - 1, 0) : j + 1].min(), 1) > 1e-3 * values[0] / len(values):
            sign = np.sign(got[:, j] @ plain[:, j])
            assert np.abs(sign * got[:, j] - plain[:, j]).max() < 1e-8 * max(1, np.abs(plain[:, j]).max())


def made(seed, rows, size, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, (rng.standard_normal(size) * spread ** np.arange(size)).astype(np.float32).tolist()) for i in range(rows)]


@pytest.mark.parametrize(("rows", "size", "spread"), [(300, 64, 0.97), (60, 7, 0.8), (9, 40, 1.0), (200, 16, 0.9), (400, 150, 0.985)])
def test_components_against_a_full_decomposition(spark, rows, size, spread):
    data = made(rows, rows, size, spread)
    check(data, whiten(spark.createDataFrame(data, SCHEMA)))


def test_nulls_repeats_lengths_and_clashing_columns(spark):
    data = made(5, 50, 6, 0.7)
    data += [(0, data[0][1]), (1, data[7][1]), (None, data[3][1]), (60, None), (61, [None] * 6), (62, [float("nan")] * 6), (63, [float("inf")] + [0.0] * 5)]
    data += [(64, data[0][1][:3]), (65, []), (66, [0.0] * 6)] + [(70, data[9][1])] * 300
    df = spark.createDataFrame(data, SCHEMA).selectExpr("*", "'x' as x", "1 as n", "2 as entries", "3 as component", "4 as v", "5 as i")
    check(data, whiten(df))


def test_nothing_to_whiten(spark):
    for data in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [0.5, 0.5]) for i in range(20)], [(1, [])]):
        assert whiten(spark.createDataFrame(data, SCHEMA)).count() == 0


@pytest.mark.parametrize("values", [np.arange(300, 0, -1.0), np.append(np.full(30, 5.0), np.linspace(1, 0, 170)), 0.7 ** np.arange(120), np.append([1e6], np.full(99, 1.0))])
def test_pairs_reach_double_precision(values):
    rng = np.random.default_rng(1)
    basis, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    matrix = (basis * values) @ basis.T
    calls = []

    def product(u):
        calls.append(u.shape)
        return matrix @ u

    theta, vectors = largest(product, len(values), 16)
    assert np.abs(theta - np.sort(values)[::-1][:16]).max() < 1e-12 * values.max()
    assert np.abs(matrix @ vectors - vectors * theta).max() < 1e-12 * values.max()
    assert np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-12
    assert len(calls) < 400


def test_query_on_given_vectors(given):
    rows = [(r.vec_id, r.embedding) for r in given("embeddings").select("vec_id", "embedding").collect()]
    check(rows, QUERIES["op12_whitening"](given("embeddings").sparkSession, FOLDER))


def test_a_deviation_too_large_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 2)
    data = [(1, [3e8, 0.0]), (2, [-3e8, 1.0]), (3, [0.0, 5.0])]
    with pytest.raises(Exception, match="deviation"):
        whiten(spark.createDataFrame(data, "vec_id bigint, embedding array<double>")).collect()
