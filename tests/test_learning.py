"""Logistic fits, the table of answers, batches of series and the streaming fill."""

import itertools
import os
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohort_spark.operators import models, prompts, vectors
from cohort_spark.operators.answers import answered, ask_missing, stored_answers, with_answers
from cohort_spark.operators.clients import HashingEmbedder, RuleClient, StatisticsEmbedder
from cohort_spark.operators.impute import forward_fill
from cohort_spark.operators.logistic import Setting, fit_many
from cohort_spark.streaming.fill import forward_fill_stream
from tests.conftest import rows


def table(frame, x, y, fold=None):
    names = [f"f{i}" for i in range(x.shape[1])]
    schema = ", ".join(["entity_id bigint", *[f"{n} double" for n in names], "label int", "fold int"])
    fold = [None] * len(y) if fold is None else fold
    data = [(i, *map(float, v), None if k is None else int(k), f) for i, (v, k, f) in enumerate(zip(x, y, fold))]
    return models.to_features(frame(schema, data), names, ["entity_id", "label", "fold"])


def made(seed, n, d):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * np.arange(1, d + 1)
    return x, (x @ rng.normal(size=d) + rng.normal(size=n) * d > 0).astype(int)


def slope(x, y, model):
    w, b = model.coefficients.toArray(), model.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    return x.T @ (p - y), (p - y).sum(), w


@pytest.mark.parametrize("C", [0.001, 1.0, 100.0])
def test_l2_optimum(frame, C):
    x, y = made(1, 150, 4)
    gradient, free, w = slope(x, y, models.fit_logistic(table(frame, x, y), C=C))
    assert gradient + w / C == pytest.approx(np.zeros(4), abs=1e-7) and free == pytest.approx(0, abs=1e-7)


@pytest.mark.parametrize("C", [0.001, 0.05, 100.0])
def test_l1_optimum(frame, C):
    x, y = made(2, 150, 6)
    gradient, free, w = slope(x, y, models.fit_logistic(table(frame, x, y), C=C, penalty="l1"))
    assert free == pytest.approx(0, abs=1e-7)
    for g, v in zip(gradient, w):
        assert abs(g) <= 1 / C + 1e-7 if v == 0 else g + np.sign(v) / C == pytest.approx(0, abs=1e-7)
    assert C > 0.01 or not w.any()


def test_all_models_of_a_search_share_their_passes(spark, frame):
    x, y = made(3, 120, 3)
    fold = [i % 4 for i in range(120)]
    df = table(frame, x, y, fold)
    settings = [Setting(c, f) for c in (0.01, 1.0, 10.0) for f in (0, 1, 2, 3, None)]
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    fitted = fit_many(df, settings)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 60  # one search of its own per model would take hundreds
    for s, model in zip(settings, fitted):
        use = np.array([f != s.fold for f in fold])
        gradient, free, w = slope(x[use], y[use], model)
        assert gradient + w / s.C == pytest.approx(np.zeros(3), abs=1e-7) and free == pytest.approx(0, abs=1e-7)
    best, scores = models.grid_search_logistic(df, C=[0.01, 1.0, 10.0], folds=4)
    by_strength = {r.C: r.auroc for r in scores.collect()}
    for c in (0.01, 1.0, 10.0):
        found = []
        for f, model in zip(range(4), (m for s, m in zip(settings, fitted) if s.C == c)):
            here = np.array(fold) == f
            z = x[here] @ model.coefficients.toArray()
            a, b = z[y[here] == 1], z[y[here] == 0]
            found.append(((a[:, None] > b) + 0.5 * (a[:, None] == b)).mean())
        assert by_strength[c] == pytest.approx(np.mean(found))
    top = max(by_strength, key=by_strength.get)
    whole = [m for s, m in zip(settings, fitted) if s.C == top and s.fold is None][0]
    assert best.coefficients.toArray() == pytest.approx(whole.coefficients.toArray(), abs=1e-8)


def test_one_class_missing_labels_and_no_rows(frame):
    x, y = made(4, 20, 2)
    assert models.fit_logistic(table(frame, x, [1] * 20)).intercept == np.inf
    mixed = models.fit_logistic(table(frame, x, [None if i < 4 else k for i, k in enumerate(y)]))
    assert slope(x[4:], y[4:], mixed)[1] == pytest.approx(0, abs=1e-7)
    empty = table(frame, x, y).limit(0)
    model = models.fit_logistic(empty)
    assert model.intercept == 0.0 and models.predict_positive(model, empty, ["entity_id"]).count() == 0
    constant = models.fit_logistic(table(frame, np.ones((20, 1)), y))
    assert slope(np.ones((20, 1)), y, constant)[1] == pytest.approx(0, abs=1e-7)


class Counting:
    """Leaves a file per call in a folder, so calls of all tasks and runs can be counted."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self, system, prompt):
        open(os.path.join(self.folder, uuid.uuid4().hex), "w").close()
        return f"{len(prompt) % 9 + 1}"


def test_no_prompt_is_asked_twice(frame, tmp_path):
    calls, store = tmp_path / "calls", str(tmp_path / "store")
    calls.mkdir()
    make = lambda: Counting(str(calls))
    data = [(i, "s" if i % 2 else "t", f"prompt {i % 10}") for i in range(60)] + [(99, "s", None), (98, None, "prompt 1")]
    df = frame("entity_id bigint, system string, prompt string", data)
    first = rows(answered(df, make, store, ["entity_id"], partitions=3))
    assert len(os.listdir(calls)) == 11  # ten pairs, and one without a system text
    assert {i: a for i, a in first}[99] is None and {i: a for i, a in first}[0] == "9"
    again = rows(answered(df, make, store, ["entity_id"]))
    assert again == first and len(os.listdir(calls)) == 11
    more = frame("entity_id bigint, system string, prompt string", [(1, "s", "prompt 1"), (2, "s", "new"), (3, "s", "new")])
    ask_missing(more, make, store)
    assert len(os.listdir(calls)) == 12 and with_answers(more, store).where("answer is null").count() == 0
    assert stored_answers(df.sparkSession, store).count() == 12


def test_a_sweep_over_the_same_store_asks_nothing(frame, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    data = [(i, f"level {i % 5 * 10}", int(i % 5 > 2)) for i in range(40)]
    df = frame("entity_id bigint, one string, label int", data)
    make = lambda: Counting(str(calls))
    first = rows(prompts.prompt_sweep(df, df, ["one"], "label", make, store=str(tmp_path / "store")))
    asked = len(os.listdir(calls))
    assert asked == 20  # five texts in two modes, with and without examples
    assert rows(prompts.prompt_sweep(df, df, ["one"], "label", make, store=str(tmp_path / "store"))) == first
    assert len(os.listdir(calls)) == asked
    assert len(rows(prompts.prompt_sweep(df, df, ["one"], "label", RuleClient))) == 4


def test_batches_of_series():
    lengths = [random.Random(i).randint(1, 40) for i in range(200)]
    found = list(vectors.batches_by_length(lengths, 100))
    assert sorted(itertools.chain(*found)) == list(range(200))
    assert all(len(b) == 1 or len(b) * max(lengths[i] for i in b) <= 100 for b in found)
    assert list(vectors.batches_by_length([], 100)) == []


def test_padding_does_not_change_tokens(frame):
    rng = random.Random(3)
    data = [(e, f"2024-01-{d + 1:02d} 00:00:00", rng.random()) for e in range(12) for d in range(1 + e * 2)]
    df = frame("entity_id bigint, ts timestamp_ntz, x double", data)
    whole, single = (
        {r.entity_id: r.tokens for r in vectors.embed_series(df, ["x"], StatisticsEmbedder, batch_tokens=n, chunk_hours=None).collect()}
        for n in (1 << 16, 1)
    )
    assert whole == single and all(len(whole[e]) == 1 + e * 2 for e in range(12))
    series = np.array([v for e, _, v in data if e == 5])
    want = np.stack([series, np.diff(series, prepend=series[0]), np.cumsum(series) / np.arange(1, 12), np.maximum.accumulate(series), np.minimum.accumulate(series)], axis=1)
    assert np.allclose(whole[5], want)


def test_hashing_embedder_handles_odd_texts():
    got = HashingEmbedder(8)(["A b", "b a", None, "", "日本 é"])
    assert np.allclose(got[0], got[1]) and not got[2].any() and not got[3].any() and np.linalg.norm(got[4]) == pytest.approx(1)


def test_streaming_fill_is_that_of_the_batch(spark, frame, tmp_path):
    rng = random.Random(9)
    schema = "entity_id bigint, ts timestamp_ntz, variable string, value double"
    cells = [
        (e, f"2024-01-01 {h:02d}:{m:02d}:00", v, None if rng.random() < 0.6 else round(rng.random(), 3))
        for e in (1, 2, 3) for v in ("a", "b") for h in range(6) for m in (0, 20, 40) if rng.random() < 0.8
    ]
    end = [(9, "2024-01-02 12:00:00", "a", 0.0)]  # moves the watermark past all others
    early = [c for c in cells if c[1] < "2024-01-01 03:30:00"]
    late = [c for c in cells if c not in early]
    swap = [c for c in early if c[1] >= "2024-01-01 02:30:00"][::3]  # arrive a batch late, within the delay
    parts = [[c for c in early if c not in swap], late + swap, end, [(9, "2024-01-02 13:00:00", "a", 0.0)]]
    for part in parts:
        rng.shuffle(part)
        frame(schema, part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame(schema, cells).schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(str(tmp_path / "in"))
    query = (
        forward_fill_stream(stream, delay="2 hours").writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    got = rows(spark.read.parquet(str(tmp_path / "out")).where("entity_id < 9"), "entity_id", "variable", "ts")
    long = frame(schema, cells).withColumn("key", F.concat_ws("/", "entity_id", "variable"))
    filled = forward_fill(long, ["value"], ["ts"], entity="key", chunk_hours=None)
    assert got == rows(filled.select("entity_id", "variable", "ts", "value"), "entity_id", "variable", "ts")


def test_streaming_fill_leaves_out_what_comes_after_the_delay(spark, frame, tmp_path):
    schema = "entity_id bigint, ts timestamp_ntz, variable string, value double"
    parts = [
        [(1, "2024-01-01 00:00:00", "a", 1.0), (1, "2024-01-01 09:00:00", "a", None)],
        [(2, "2024-01-01 10:00:00", "a", 5.0)],
        [(1, "2024-01-01 01:00:00", "a", 7.0), (1, "2024-01-01 12:00:00", "a", None), (2, None, "a", 3.0)],
        [(2, "2024-01-03 00:00:00", "a", None)],
        [(3, "2024-01-04 00:00:00", "a", None)],
    ]
    for part in parts:
        frame(schema, part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame(schema, parts[0]).schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = (
        forward_fill_stream(stream, delay="1 hour").writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    got = [(e, str(t), v) for e, _, t, v in rows(spark.read.parquet(str(tmp_path / "out")), "entity_id", "ts")]
    assert (1, "2024-01-01 01:00:00", 7.0) not in got
    assert [(str(t)[11:], v) for e, t, v in got if e == 1] == [("00:00:00", 1.0), ("09:00:00", 1.0), ("12:00:00", 1.0)]
    assert [v for e, _, v in got if e == 2] == [5.0, 5.0]
