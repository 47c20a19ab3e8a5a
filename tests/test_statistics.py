"""Quantiles, tests, features, metrics and silhouette against direct computation."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohort_spark.operators import explore, features, metrics
from cohort_spark.operators.silhouette import silhouette, silhouette_squared
from cohort_spark.plans.runs import exact_quantiles
from tests.conftest import rows


@pytest.mark.parametrize("chunks", [1, 3, 50])
def test_quantiles_of_skewed_groups(frame, chunks):
    rng = random.Random(1)
    data = [("hot", round(rng.expovariate(0.1), 1)) for _ in range(900)] + [("cold", float(i)) for i in range(7)]
    data += [("one", 3.0), ("none", None), ("hot", 5.0), ("hot", 5.0)]
    df = frame("g string, x double", data)
    got = {r[0]: r[1:] for r in rows(exact_quantiles(df, "x", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}, ["g"], chunks))}
    for g in ("hot", "cold", "one"):
        values = [x for k, x in data if k == g]
        assert got[g] == pytest.approx(tuple(np.percentile(values, [0, 25, 50, 90, 100])))
    assert "none" not in got


def test_summary_and_box(frame):
    df = frame("g string, x double", [("a", float(v)) for v in (1, 2, 3, 4, 100)] + [("a", None)])
    assert rows(explore.summary_stats(df, ["x"])) == [("x", 1.0, 2.0, 3.0, 22.0, 4.0, 100.0, 1)]
    assert rows(explore.box_stats(df, "x", ["g"])) == [("a", 2.0, 3.0, 4.0, 1.0, 4.0, 1, 5)]
    assert rows(explore.frequency_table(df, "g")) == [("a", 6)]


def test_density_integrates_to_one(frame):
    rng = random.Random(2)
    df = frame("x double", [(rng.gauss(0, 1),) for _ in range(200)])
    curve = rows(explore.kde(df, "x", cut=4), "point")
    xs, ys = np.array([r[1] for r in curve]), np.array([r[2] for r in curve])
    assert ((ys[1:] + ys[:-1]) / 2 * np.diff(xs)).sum() == pytest.approx(1, abs=1e-3)


def binned_density(x, points=512, cut=0.0):
    """The same estimate by a circular Fourier transform of the binned weights."""
    x = np.asarray(x)
    iqr = (np.quantile(x, 0.75) - np.quantile(x, 0.25)) / 1.34
    bw = 0.9 * min(x.std(ddof=1), iqr) * len(x) ** -0.2
    low, high = x.min() - cut * bw, x.max() + cut * bw
    lo, up = low - 4 * bw, high + 4 * bw
    place = (x - lo) / (up - lo) * (points - 1)
    bins = np.zeros(2 * points)
    np.add.at(bins, np.floor(place).astype(int), (1 - place % 1) / len(x))
    np.add.at(bins, np.floor(place).astype(int) + 1, (place % 1) / len(x))
    away = np.arange(2 * points) * (up - lo) / (points - 1)
    away[points + 1 :] = -away[points - 1 : 0 : -1]
    kernel = np.exp(-((away / bw) ** 2) / 2) / (bw * np.sqrt(2 * np.pi))
    heights = np.maximum(0, np.fft.ifft(np.fft.fft(bins) * np.conj(np.fft.fft(kernel))).real[:points])
    at = np.linspace(low, high, points)
    return at, np.interp(at, np.linspace(lo, up, points), heights)


@pytest.mark.parametrize("cut", [0, 3])
def test_density_is_that_of_binned_weights(frame, cut):
    rng = random.Random(4)
    x = [rng.gauss(0, 1) if rng.random() < 0.7 else rng.gauss(6, 0.5) for _ in range(700)] + [2.5] * 60
    curve = rows(explore.kde(frame("x double", [(v,) for v in x]), "x", cut=cut), "point")
    at, y = binned_density(x, cut=cut)
    assert [r[1] for r in curve] == pytest.approx(at.tolist())
    assert [r[2] for r in curve] == pytest.approx(y.tolist(), abs=1e-9)


@pytest.mark.parametrize("cut", [0, 3])
def test_exact_density_sums_the_kernel_of_every_value(frame, cut):
    rng = random.Random(5)
    data = [("a", rng.gauss(0, 1) if rng.random() < 0.7 else rng.gauss(6, 0.5)) for _ in range(300)] + [("a", 2.5)] * 40
    data += [(None, rng.expovariate(1)) for _ in range(200)] + [("a", None)]
    got = rows(explore.kde(frame("g string, x double", data), "x", ["g"], cut=cut, exact=True), "g", "point")
    for g in ("a", None):
        x = np.array([v for k, v in data if k == g and v is not None])
        bw = 0.9 * min(x.std(ddof=1), (np.quantile(x, 0.75) - np.quantile(x, 0.25)) / 1.34) * len(x) ** -0.2
        at = np.linspace(x.min() - cut * bw, x.max() + cut * bw, 512)
        y = np.exp(-(((at[:, None] - x) / bw) ** 2) / 2).sum(axis=1) / (len(x) * bw * np.sqrt(2 * np.pi))
        curve = [r for r in got if r[0] == g]
        assert [r[2] for r in curve] == pytest.approx(at.tolist())
        assert [r[3] for r in curve] == pytest.approx(y.tolist(), rel=1e-9, abs=1e-12)


def test_registered_density_is_exact(spark, tmp_path):
    from __spark_entry__ import queries

    rng = random.Random(6)
    prices = [900.0, 901.5, 950.0, 2000.0] + [round(rng.uniform(900, 1100), 2) for _ in range(60)]
    spark.createDataFrame([(p,) for p in prices], "p_retailprice double").write.parquet(str(tmp_path / "part.parquet"))
    got = rows(queries()["kde"](spark, str(tmp_path)), "point")
    x = np.array(prices)
    bw = 0.9 * min(x.std(ddof=1), (np.quantile(x, 0.75) - np.quantile(x, 0.25)) / 1.34) * len(x) ** -0.2
    y = np.exp(-(((np.linspace(x.min(), x.max(), 512)[:, None] - x) / bw) ** 2) / 2).sum(axis=1) / (len(x) * bw * np.sqrt(2 * np.pi))
    assert [r[2] for r in got] == pytest.approx(y.tolist(), abs=2e-9)


def test_density_of_groups_sums_bins_alone(frame):
    df = frame("g string, x double", [("a", float(i % 97)) for i in range(500)] + [("b", 3.0)] * 4 + [("c", 1.0), ("d", None)])
    curves = explore.kde(df, "x", ["g"], cut=4)
    assert curves.groupBy("g").count().where("count <> 512").count() == 0
    areas = {g: [(r[2], r[3]) for r in rows(curves, "g", "point") if r[0] == g] for g in "abc"}
    for g in "ab":
        xs, ys = np.array(areas[g]).T
        assert ((ys[1:] + ys[:-1]) / 2 * np.diff(xs)).sum() == pytest.approx(1, abs=2e-3)


def test_p_values_of_missing_statistics_end(frame):
    nan, inf = float("nan"), float("inf")
    df = frame("s double, d double", [(None, 3.0), (nan, 3.0), (1.0, None), (1.0, 0.0), (1.0, nan), (inf, 3.0), (-inf, 3.0), (2.0, inf), (0.0, 2.0)])
    got = df.select(explore.chi_square_p("s", "d").alias("c"), explore.t_test_p("s", "d").alias("t"), explore.normal_p("s").alias("z"))
    c, t, z = zip(*[tuple(nan if v is None else v for v in r) for r in got.collect()])
    assert c == pytest.approx((nan,) * 5 + (0.0, 1.0, 1.0, 1.0), nan_ok=True)
    assert t == pytest.approx((nan,) * 5 + (0.0, 0.0, 0.0455, 1.0), abs=1e-4, nan_ok=True)
    assert z == pytest.approx((nan, nan, 0.3173, 0.3173, 0.3173, 0.0, 0.0, 0.0455, 1.0), abs=1e-4, nan_ok=True)


def test_tests_of_constant_columns_and_empty_tables_end(frame):
    same = frame("g string, x double", [("a", 1.0)] * 3 + [("b", 1.0)] * 3)
    r = explore.welch_t(same, "x", "g").withColumn("p", explore.t_test_p("t", "df")).first()
    assert r.t is None and (r.p is None or math.isnan(r.p))
    none = explore.chi_square(frame("r string, c string", [("a", "x")]).limit(0), "r", "c")
    assert all(r.p is None or math.isnan(r.p) for r in none.withColumn("p", explore.chi_square_p("statistic", F.col("df").cast("double"))).collect())


def test_chi_square_and_welch(frame):
    table = {("a", "x"): 10, ("a", "y"): 20, ("b", "x"): 30, ("b", "y"): 5, ("c", "x"): 8}
    df = frame("r string, c string", [k for k, n in table.items() for _ in range(n)])
    seen = np.array([[10, 20], [30, 5], [8, 0]])
    expected = seen.sum(1, keepdims=True) * seen.sum(0) / seen.sum()
    statistic = ((seen - expected) ** 2 / expected).sum()
    test = explore.chi_square(df, "r", "c")
    got = test.withColumn("p", explore.chi_square_p("statistic", F.col("df").cast("double"))).first()
    assert got.statistic == pytest.approx(statistic) and got.df == 2
    assert got.cramers_v == pytest.approx(math.sqrt(statistic / seen.sum()))
    assert got.p == pytest.approx(math.exp(-statistic / 2))
    two = frame("r string, c string", [("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 30 + [("b", "y")] * 5)
    small = np.array([[10, 20], [30, 5]])
    expected = small.sum(1, keepdims=True) * small.sum(0) / small.sum()
    assert explore.chi_square(two, "r", "c").first().statistic == pytest.approx(
        ((np.abs(small - expected) - 0.5) ** 2 / expected).sum()
    )
    one, other = [1.0, 2.0, 3.0, 4.0], [2.0, 8.0, 6.0]
    t = frame("g int, x double", [(0, v) for v in one] + [(1, v) for v in other])
    got = explore.welch_t(t, "x", "g").first()
    a, b = np.var(one, ddof=1) / 4, np.var(other, ddof=1) / 3
    assert got.t == pytest.approx((np.mean(one) - np.mean(other)) / math.sqrt(a + b))
    assert got.df == pytest.approx((a + b) ** 2 / (a * a / 3 + b * b / 2))


@pytest.mark.parametrize("bounded", [True, False])
def test_minimal_features(frame, bounded):
    df = frame("entity_id int, x double", [(1, 3.0), (1, -4.0), (1, None), (1, 1.0), (2, None)])
    got = {r[0]: r[1:] for r in rows(features.extract_minimal_features(df, ["x"], bounded=bounded))}
    values = np.array([3.0, -4.0, 1.0])
    assert got[1] == pytest.approx(
        (0.0, 1.0, 0.0, 3.0, values.std(), values.var(), math.sqrt((values**2).mean()), 3.0, 4.0, -4.0)
    )
    assert got[2][0] == 0.0 and got[2][3] == 0.0


def test_relevance_and_selection(frame):
    rng = random.Random(4)
    data = []
    for i in range(80):
        y = i % 2
        data.append((i, y, rng.gauss(2 * y, 1), rng.gauss(0, 1), float(rng.random() < 0.2 + 0.6 * y), 5.0))
    df = frame("entity_id int, label int, good double, noise double, flag double, flat double", data)
    p = {r[0]: r[2] for r in rows(features.feature_relevance(df.drop("label"), df, ["good", "noise", "flag", "flat"]))}
    assert set(p) == {"good", "noise", "flag"} and p["good"] < 1e-6 and p["noise"] > 0.01 and p["flag"] < 0.01
    chosen = features.select_relevant(frame("feature string, p double", list(p.items())))
    assert {r[0] for r in rows(chosen)} == {"good", "flag"}
    aligned = features.align_features(df, ["flag", "absent"])
    assert aligned.columns == ["entity_id", "flag", "absent"]


def test_fisher_of_a_known_table(frame):
    df = frame("a int, b int, c int, d int", [(8, 2, 1, 5), (0, 0, 0, 0)])
    got = [r[0] for r in df.select(features.fisher_p("a", "b", "c", "d")).collect()]
    assert got[0] == pytest.approx(0.03496503496503495) and got[1] == 1.0


def brute_metrics(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y]
    neg = [s for s, y in zip(scores, labels) if not y]
    roc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    ap, found = 0.0, 0
    for s in sorted(set(scores), reverse=True):
        hits = sum(y for t, y in zip(scores, labels) if t == s)
        found += hits
        ap += hits / len(pos) * found / sum(t >= s for t in scores)
    return roc, ap


def test_metrics_with_ties_and_one_class(frame):
    rng = random.Random(6)
    data = [("many", rng.randint(0, 9) / 10, int(rng.random() < 0.4)) for _ in range(300)]
    data += [("pos", 0.3, 1), ("pos", 0.6, 1), ("neg", 0.6, 0)]
    df = frame("g string, score double, label int", data)
    got = {r.g: r for r in metrics.evaluate(df, by=["g"]).collect()}
    many = [(s, y) for g, s, y in data if g == "many"]
    roc, ap = brute_metrics(*zip(*many))
    assert (got["many"].auroc, got["many"].average_precision) == pytest.approx((roc, ap))
    eps = 2.220446049250313e-16
    loss = np.mean([-math.log(max(s, eps)) if y else -math.log(max(1 - s, eps)) for s, y in many])
    assert got["many"].log_loss == pytest.approx(loss)
    assert got["pos"].auroc is None and got["neg"].average_precision is None and got["pos"].n == 2
    flipped = metrics.auroc(df.where("g = 'many'").withColumn("score", -F.col("score"))).first()[0]
    assert flipped == pytest.approx(1 - roc)


def brute_silhouette(points, labels, power):
    x = np.array(points)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) ** power
    out = []
    for i, c in enumerate(labels):
        own = [j for j in range(len(x)) if labels[j] == c and j != i]
        if not own:
            out.append(0.0)
            continue
        a = d[i, own].mean()
        b = min(d[i, [j for j in range(len(x)) if labels[j] == o]].mean() for o in set(labels) - {c})
        out.append((b - a) / max(a, b))
    return np.mean(out)


@pytest.mark.parametrize("block", [4000, 7])
def test_silhouette(frame, monkeypatch, block):
    import sys

    monkeypatch.setattr(sys.modules["cohort_spark.operators.silhouette"], "BLOCK_ROWS", block)
    rng = random.Random(8)
    labels = [0] * 15 + [1] * 10 + [2]
    points = [[rng.gauss(c * 2, 1), rng.gauss(-c, 1)] for c in labels]
    df = frame("vec_id int, x double, y double, label int", [(i, *p, c) for i, (p, c) in enumerate(zip(points, labels))])
    df = df.withColumn("embedding", F.array("x", "y"))
    assert silhouette(df).first()[0] == pytest.approx(brute_silhouette(points, labels, 1))
    assert silhouette_squared(df).first()[0] == pytest.approx(brute_silhouette(points, labels, 2))


def test_p_values_hold_for_any_degrees_of_freedom():
    for df in (1e8, 1e9):
        below = explore._gamma_q(df / 2, (df - math.sqrt(2 * df)) / 2)
        assert below == pytest.approx(0.8413447, abs=2e-5)
        assert explore._t_tail(1.96, df) == pytest.approx(math.erfc(1.96 / math.sqrt(2)), rel=1e-7)
    for low, high in ((1.99e5, 2.01e5), (199_990.0, 200_010.0)):  # both sides of the change of form agree
        for z in (-2.5, -0.3, 0.0, 1e-5, 0.7, 3.0):
            tails = [explore._gamma_q(d / 2, (d + z * math.sqrt(2 * d)) / 2) for d in (low, high)]
            assert tails[0] == pytest.approx(tails[1], abs=2e-5)
    for d in (2, 4, 10, 60):  # an even number of degrees: a finite sum
        x = d * 0.9
        total = sum(math.exp(i * math.log(x / 2) - x / 2 - math.lgamma(i + 1)) for i in range(d // 2))
        assert explore._gamma_q(d / 2, x / 2) == pytest.approx(total, rel=1e-12)
    assert explore._t_tail(2.0, 1) == pytest.approx(1 - 2 * math.atan(2) / math.pi, rel=1e-12)


def test_welch_t_needs_two_groups(frame):
    three = frame("g int, x double", [(g, float(x)) for g in range(3) for x in range(3)])
    with pytest.raises(Exception, match="found 3"):
        explore.welch_t(three, "x", "g").collect()
    with pytest.raises(Exception, match="found 1"):
        explore.welch_t(three.where("g = 1"), "x", "g").collect()


def test_nan_is_no_value(frame):
    df = frame("x double", [(1.0,), (float("nan"),), (3.0,), (None,)])
    assert exact_quantiles(df, "x", {"m": 0.5}).first().m == 2.0


@pytest.mark.parametrize("block_rows", [7, 30, 4000])
def test_blocks_of_a_silhouette_meet_once(frame, monkeypatch, block_rows):
    from cohort_spark.operators import silhouette as module

    monkeypatch.setattr(module, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(3)
    x, labels = rng.normal(size=(90, 3)), rng.integers(0, 4, 90)
    df = frame("vec_id bigint, a double, b double, c double, label int", [(i, *map(float, v), int(k)) for i, (v, k) in enumerate(zip(x, labels))])
    points = df.select("vec_id", F.array("a", "b", "c").alias("embedding"), "label")
    found = silhouette(points)
    assert found.first()[0] == pytest.approx(brute_silhouette(x, labels, 1))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1  # one copy of a row per block, where two sides would take two
