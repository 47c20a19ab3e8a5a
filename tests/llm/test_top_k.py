import math
import random

import pytest
from pyspark.sql import functions as F

from cohort_spark.llm import top_k as module
from cohort_spark.llm.top_k import top_k

VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute(rows, is_query, k):
    usable = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    queries = {}
    for i, v in usable:
        if is_query(i):
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, v in queries.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize(("seed", "scale"), [(1, 1.0), (2, 1e5)])
def test_against_brute_force(spark, seed, scale, monkeypatch):
    monkeypatch.setattr(module, "ROW_BLOCK", 50)
    monkeypatch.setattr(module, "QUERY_BLOCK", 8)
    rng = random.Random(seed)
    rows = [(i, [round(rng.gauss(0, scale), 2) * 0.5 for _ in range(8)]) for i in range(300)]
    rows = [(i, [float(x) for x in v]) for i, v in rows]
    rows += [(300 + i, rows[10][1]) for i in range(80)]  # a very common vector
    rows += [(700, None), (710, []), (720, [1.0, None]), (730, [float("nan")]), (740, [float("inf")] * 8), (None, [1.0] * 8)]
    rows += [(750, [0.0] * 8), (760, [2.0] * 3), (770, [-1.0] * 12), (10, rows[10][1]), (10, rows[11][1]), (5, rows[5][1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS.replace("float", "double")).repartition(5)
    got = sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 10 == 0, 7).collect())
    assert got == brute(rows, lambda i: i % 10 == 0, 7)


def test_few_rows_and_none(spark):
    make = lambda rows: spark.createDataFrame(rows, VECTORS)
    got = top_k(make([(0, [1.0, -1.0], 0), (1, [0.5, 0.25], 0), (2, [0.1, 0.2], 0)]), F.col("vec_id") == 0)
    assert sorted(tuple(r) for r in got.collect()) == [(0, 1, 1, 1024 * 512 - 1024 * 256), (0, 2, 2, 1024 * 102 - 1024 * 204)]
    assert top_k(make([(0, [1.0], 0)]), F.col("vec_id") == 0).count() == 0
    assert top_k(make([(1, [1.0], 0)]), F.col("vec_id") == 0).count() == 0
    assert top_k(make([]), F.col("vec_id") == 0).count() == 0
