"""Reshape, quality, imputation and scaling on hand-made panels."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohort_spark.operators import aggregate, impute, quality, relate, reshape, scale
from cohort_spark.operators.knn import knn_impute
from cohort_spark.operators import knn as knn_module
from tests.conftest import rows

PANEL = "entity_id bigint, ts timestamp_ntz, x double"


def at(hour):
    return f"2024-01-01 {hour:02d}:00:00"


def test_pivot_takes_the_first_reading(frame):
    df = frame(
        "entity_id bigint, ts timestamp_ntz, variable string, value double, line bigint",
        [(1, at(0), "HR", None, 1), (1, at(0), "HR", 80.0, 2), (1, at(0), "HR", 90.0, 3), (1, at(0), None, 5.0, 4),
         (1, at(1), "Temp", None, 5)],
    )
    wide = reshape.pivot_first(df, ["entity_id", "ts"], ["HR", "Temp"], "line")
    assert rows(wide.select("HR", "Temp")) == [(80.0, None)]


def test_discretize_means_per_started_hour(frame):
    df = frame(PANEL, [(1, "2024-01-01 00:10:00", 1.0), (1, "2024-01-01 01:00:00", 3.0), (1, "2024-01-01 01:00:01", 9.0)])
    got = rows(reshape.discretize(df, ["x"]))
    assert [(str(t), x) for _, t, x in got] == [(at(1), 2.0), (at(2), 9.0)]


@pytest.mark.parametrize("chunk", [None, 2])
def test_missing_hours_are_inserted(frame, chunk):
    df = frame(PANEL, [(1, at(0), 1.0), (1, at(1), 2.0), (1, at(4), 3.0), (2, at(5), 4.0)])
    got = rows(reshape.fill_missing_hours(df, 6, chunk_hours=chunk))
    assert [t.hour for e, t, _ in got if e == 1] == [0, 1, 2, 3, 4, 5, 6]
    assert [t.hour for e, t, _ in got if e == 2] == [5, 6, 7, 8, 9, 10, 11]
    assert sum(x is not None for *_, x in got) == 4


def test_sentinels(frame):
    df = frame(PANEL, [(1, at(0), -1.0), (1, at(1), 5.0), (2, at(0), 5.0), (2, at(1), -1.0), (3, at(0), -1.0), (3, at(1), -1.0)])
    bad = quality.sentinel_violations(df, ["x"], ["ts"])
    assert rows(bad) == [(2, False), (3, False)]
    assert quality.sentinel_to_null(df, ["x"]).where("x is null").count() == 4


def test_profile_and_checks(frame):
    df = frame("entity_id bigint, a double, b int", [(1, None, 0), (1, 2.0, 1), (2, -3.0, None)])
    assert rows(quality.null_profile(df, ["a", "b"])) == [("a", 1, 1 / 3), ("b", 1, 1 / 3)]
    assert rows(quality.domain_check(df, {"b": [0, 1]})) == [("b", 0, True)]
    assert rows(quality.varying_entities(df, "b")) == [(1, 0, 1)]
    assert rows(quality.singleton_entities(df)) == [(2, 1)]
    assert quality.negative_rows(df, ["a"]).count() == 1
    assert rows(quality.entities_in(df, [2]).select("a")) == [(-3.0,)]


@pytest.mark.parametrize("chunk", [None, 1, 3])
def test_forward_fill_and_interpolation_of_gaps(frame, chunk):
    df = frame(PANEL, [(1, at(0), None), (1, at(1), 2.0), (1, at(3), None), (1, at(5), 6.0), (1, at(8), None), (2, at(0), None)])
    filled = rows(impute.forward_fill(df, ["x"], ["ts"], chunk_hours=chunk))
    assert [x for *_, x in filled] == [None, 2.0, 2.0, 6.0, 6.0, None]
    again = impute.forward_fill(impute.forward_fill(df, ["x"], ["ts"], chunk_hours=chunk), ["x"], ["ts"], chunk_hours=chunk)
    assert rows(again) == filled
    linear = rows(impute.interpolate_time(df, ["x"], chunk_hours=chunk))
    assert [x for *_, x in linear] == [2.0, 2.0, 4.0, 6.0, 6.0, None]


@pytest.mark.parametrize("chunk", [None, 1])
def test_global_interpolation_uses_other_entities(frame, chunk):
    a_b = [(1, at(0), None), (1, at(2), 10.0), (1, at(4), None), (2, at(0), 0.0), (2, at(1), None), (2, at(4), None)]
    got = rows(impute.interpolate_time(frame(PANEL, a_b), ["x"], scope="global", chunk_hours=chunk))
    assert [x for *_, x in got] == [0.0, 10.0, 10.0, 0.0, 5.0, 10.0]
    got = rows(impute.interpolate_time(frame(PANEL, [*a_b, (3, at(2), 7.0)]), ["x"], scope="global", chunk_hours=chunk))
    assert [x for *_, x in got] == [0.0, 10.0, 7.0, 0.0, 5.0, 7.0, 7.0]


def test_chunks_do_not_change_a_hot_history(frame):
    """One entity holds most rows; chunked and plain windows agree on fills, lags and numbers."""
    random.seed(3)
    start = dt.datetime(2024, 1, 1)
    data = []
    for entity, n in [(1, 600), (2, 40), (3, 1)]:
        for i in sorted(random.sample(range(5000), n)):
            value = None if random.random() < 0.6 else float(random.randint(0, 9))
            data.append((entity, str(start + dt.timedelta(minutes=i)), value))
    df = frame(PANEL, data)
    assert rows(impute.forward_fill(df, ["x"], ["ts"], chunk_hours=0.5)) == rows(
        impute.forward_fill(df, ["x"], ["ts"], chunk_hours=None)
    )
    for lags in ([1], [1, 2, 7]):
        plain = aggregate.lag_features(df, ["x"], ["ts"], lags, chunk_hours=None)
        assert rows(aggregate.lag_features(df, ["x"], ["ts"], lags, chunk_hours=0.25), "entity_id", "ts") == rows(
            plain, "entity_id", "ts"
        )
    got = rows(impute.interpolate_time(df, ["x"], chunk_hours=0.5), "entity_id", "ts")
    assert got == rows(impute.interpolate_time(df, ["x"], chunk_hours=None), "entity_id", "ts")


def brute_knn(table, k):
    ids = sorted(table)
    m = len(table[ids[0]])
    out = {}
    for i in ids:
        row = list(table[i])
        for c in range(m):
            if table[i][c] is not None:
                continue
            near = []
            for j in ids:
                shared = [d for d in range(m) if table[i][d] is not None and table[j][d] is not None]
                if table[j][c] is not None and shared:
                    gap = sum((table[i][d] - table[j][d]) ** 2 for d in shared)
                    near.append((m / len(shared) * gap, j))
            chosen = [table[j][c] for _, j in sorted(near)[:k]]
            known = [table[j][c] for j in ids if table[j][c] is not None]
            row[c] = float(np.mean(chosen)) if chosen else float(np.mean(known))
        out[i] = row
    return out


@pytest.mark.parametrize("cell_rows, slice_rows", [(2000, 20_000), (5, 20_000), (5, 7)])
def test_knn_equals_brute_force(frame, monkeypatch, cell_rows, slice_rows):
    monkeypatch.setattr(knn_module, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(knn_module, "SLICE_ROWS", slice_rows)
    rng = random.Random(5)
    table = {}
    for i in range(120):
        row = [float(rng.randint(0, 20)), float(rng.randint(0, 1)), rng.uniform(0, 50), float(rng.randint(0, 3))]
        table[i] = [None if rng.random() < 0.15 else v for v in row]
    table[120] = [None] * 4
    table |= {200 + i: [7.0, 1.0, None, 2.0] for i in range(60)}  # a hot group of equal rows
    df = frame("entity_id bigint, a double, b double, c double, d double", [(i, *v) for i, v in table.items()])
    got = {r[0]: list(r[1:]) for r in rows(knn_impute(df, ["a", "b", "c", "d"], k=5))}
    want = brute_knn(table, 5)
    assert got.keys() == want.keys()
    for i in want:
        assert got[i] == pytest.approx(want[i], abs=1e-9), i


def searched_pairs(n, m=12, k=5):
    """Donors that the cells of ``n`` clustered rows leave to search, over all gaps of a tenth of the rows."""
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(n // 400, m)) * 20
    values = centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, m))
    values[rng.random(n) < 0.1, 0] = np.nan
    tree = knn_module._Tree(values, n // 100)
    cell = tree.cells(values)
    table = []
    for c in np.unique(cell):
        part = values[cell == c]
        known = ~np.isnan(part[0])
        assert (~np.isnan(part) == known).all()  # one pattern per cell
        ends = {f"{end}{i}": float(f(part[:, i])) if known[i] else None for i in range(m) for end, f in (("lo", np.min), ("hi", np.max))}
        table.append({"cell": int(c), "n": len(part), **ends})
    cells = knn_module._Cells(table, m, np.ones(m))
    targets = values[np.isnan(values[:, 0])]
    pairs, gaps = 0, 0
    for start in range(0, len(targets), 64):
        x = targets[start : start + 64]
        row, found = cells.needed(x, 0, k)
        pairs, gaps = pairs + int(cells.count[found].sum()), gaps + len(x)
        donors = values[~np.isnan(values[:, 0])]
        for i in range(0, len(x), 16):  # the nearest donors lie in the cells that are left
            distance = ((donors[:, 1:] - x[i, 1:]) ** 2).sum(axis=1)
            nearest = donors[np.argsort(distance)[:k]]
            assert set(tree.cells(nearest).tolist()) <= set(cells.cell[found[row == i]].tolist())
    return pairs, gaps * n


def test_knn_keeps_pruning_with_many_columns_and_rows():
    found = [searched_pairs(n) for n in (2_000, 8_000, 32_000)]
    shares = [pairs / every for pairs, every in found]
    assert shares[0] < 0.3 and shares[1] < 0.5 * shares[0] and shares[2] < 0.5 * shares[1]


def test_knn_with_more_columns_than_bits(frame):
    rng = random.Random(2)
    names = [f"c{i}" for i in range(70)]
    table = {i: [None if rng.random() < 0.02 else float(rng.randint(0, 5)) for _ in names] for i in range(40)}
    df = frame(", ".join(["entity_id bigint", *[f"{c} double" for c in names]]), [(i, *v) for i, v in table.items()])
    got = {r[0]: list(r[1:]) for r in rows(knn_impute(df, names, k=3))}
    want = brute_knn(table, 3)
    assert all(got[i] == pytest.approx(want[i]) for i in table)


def test_knn_with_few_donors_and_splits(frame):
    df = frame(
        "entity_id bigint, s string, a double, b double",
        [(1, "x", 1.0, None), (2, "x", 2.0, 5.0), (3, "x", 9.0, 7.0), (4, "y", 1.0, None), (5, "y", 1.0, 100.0)],
    )
    got = rows(knn_impute(df, ["a", "b"], k=10, split="s").select("entity_id", "b"))
    assert got == [(1, 6.0), (2, 5.0), (3, 7.0), (4, 100.0), (5, 100.0)]


def test_feature_imputation(frame):
    inf = float("inf")
    df = frame("id int, a double, b double", [(1, inf, None), (2, -inf, None), (3, 1.0, None), (4, 3.0, None), (5, None, None), (6, 8.0, None), (7, float("nan"), None)])
    got = rows(impute.impute_features(df, ["a", "b"]), "id")
    assert [r[1] for r in got] == [8.0, 1.0, 1.0, 3.0, 3.0, 8.0, 3.0]
    assert {r[2] for r in got} == {0.0}


def test_scaling(frame):
    df = frame("entity_id int, a double, b double, flat double", [(1, 1.0, 1.0, 4.0), (2, 2.0, 2.0, 4.0), (3, 3.0, 4.0, 4.0), (4, 6.0, 9.0, 4.0)])
    cols = ["a", "b", "flat"]
    z = scale.standard_scale(df, df, cols).agg(*[F.avg(c) for c in cols], *[F.stddev_pop(c) for c in cols]).first()
    assert [round(v, 9) + 0.0 for v in z] == [0, 0, 0, 1, 1, 0]
    q1, med, q3 = np.percentile([1, 2, 4, 9], [25, 50, 75])
    robust = [r[2] for r in rows(scale.robust_scale(df, df, cols))]
    assert robust == pytest.approx([(x - med) / (q3 - q1) for x in (1, 2, 4, 9)])
    assert [r[3] for r in rows(scale.minmax_scale(df, df, cols))] == [0.0] * 4
    other = frame("entity_id int, a double, b double, flat double", [(9, 11.0, 1.0, 5.0)])
    assert rows(scale.minmax_scale(other, df, ["a"])) == [(9, 2.0, 1.0, 5.0)]


def test_rules_sum_nulls_to_zero_and_skip_null_last(frame):
    df = frame(PANEL + ", y double", [(1, at(0), 1.0, None), (1, at(1), None, None)])
    assert rows(aggregate.aggregate_by_rules(df, {"x": "last", "y": "sum"}, ["ts"])) == [(1, 1.0, 0.0)]
    assert aggregate.extend_rules({"x": "max"}, ["x_lag1", "flagged"]) == {"x": "max", "x_lag1": "last"}


@pytest.mark.parametrize("chunk", [None, 2])
def test_autocorrelation_skips_constant_and_short_series(frame, chunk):
    wave = [1.0, 3.0, 2.0, 5.0, 4.0]
    df = frame(PANEL, [(1, at(i), v) for i, v in enumerate(wave)] + [(2, at(i), 7.0) for i in range(4)] + [(3, at(0), 1.0)])
    (name, acf, entities), = rows(aggregate.autocorrelations(df, ["x"], ["ts"], chunk_hours=chunk))
    assert (name, entities) == ("x", 1)
    assert acf == pytest.approx(np.corrcoef(wave[1:], wave[:-1])[0, 1])


def test_flags_static_view_and_joins(frame):
    df = frame("entity_id bigint, ts timestamp_ntz, f int", [(1, at(0), None), (1, at(1), 1), (2, at(0), 0), (2, at(1), None)])
    assert [r[2] for r in rows(impute.any_flag_to_static(df, "f"))] == [1, 1, 0, 0]
    assert rows(impute.static_view(df, ["f"], ["ts"])) == [(1, 1), (2, 0)]
    labels = frame("entity_id bigint, label int", [(1, 1)])
    assert [r[3] for r in rows(relate.attach_labels(df, labels))] == [1, 1, None, None]
    assert relate.unlabelled(df, labels).count() == 2
    assert relate.expand_settings(labels, {"a": [1, 2], "b": ["x", "y", "z"]}).count() == 6
    joined = relate.map_static(df, frame("entity_id bigint, f int", [(1, 9)]), ["f"])
    assert joined.columns == df.columns and [r[2] for r in rows(joined)] == [9, 9, None, None]


def test_samples_are_reproducible(frame):
    df = frame("entity_id bigint, x int", [(i % 10, i) for i in range(100)])
    one, two = aggregate.sample_entities(df, 3, 1), aggregate.sample_entities(df.repartition(5), 3, 1)
    assert rows(one) == rows(two) and one.count() == 30
    assert aggregate.sample_rows(df, 7, 1, "x").count() == 7


def test_long_histories_go_on_in_further_rows(frame, monkeypatch):
    from cohort_spark.operators import sequences

    monkeypatch.setattr(sequences, "MOST_STEPS", 4)
    steps = [(1, f"2024-01-01 {h:02d}:00:00", float(h)) for h in range(10)] + [(2, "2024-01-01 00:00:00", 5.0)]
    df = frame("entity_id int, ts timestamp_ntz, x double", steps)
    got = {(r.entity_id, r.segment): (r.length, [s[0] for s in r.sequence]) for r in sequences.build_sequences(df, ["x"]).collect()}
    assert got == {
        (1, 0): (4, [0.0, 1.0, 2.0, 3.0]), (1, 1): (4, [4.0, 5.0, 6.0, 7.0]), (1, 2): (2, [8.0, 9.0, 0.0, 0.0]), (2, 0): (1, [5.0, 0.0, 0.0, 0.0]),
    }
