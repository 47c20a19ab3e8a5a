"""Tokens, sequences, summaries, prompts and embeddings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohort_spark.operators import models, prompts, sequences, summaries, vectors
from cohort_spark.operators.clients import HashingEmbedder, RuleClient, StatisticsEmbedder
from tests.conftest import rows

PANEL = "entity_id bigint, ts timestamp_ntz, HR double, Temp double"


def at(hour):
    return f"2024-01-01 {hour:02d}:00:00"


@pytest.mark.parametrize("chunk", [None, 2])
@pytest.mark.parametrize(
    "series, mark",
    [
        ([5.0], "unknown"), ([1.0, 9.0], "~"), ([1.0, 2.0, 3.0], "↑"), ([9.0, 5.0, 5.0, 1.0], "↓"),
        ([5.0, 5.05, 5.0], "→"), ([1.0, 9.0, 1.0, 9.0, 1.0], "~"), ([1.0, 2.0, 3.0, 4.0], "↑"),
    ],
)
def test_trends(frame, series, mark, chunk):
    df = frame(PANEL, [(1, at(i), v, None) for i, v in enumerate(series)] + [(1, at(20), None, None)])
    got = summaries.trend_labels(df, ["HR", "Temp"], chunk_hours=chunk)
    assert rows(got.select("variable", "n", "trend")) == [("HR", len(series), mark)]


def test_summary_texts(frame):
    df = frame(
        "entity_id bigint, ts timestamp_ntz, Age double, Gender double, Weight double, HR double, Temp double, BUN double",
        [(7, at(0), 64.9, 1.0, 81.0, 80.0, None, None), (7, at(1), 64.9, 1.0, 81.0, 90.125, 37.0, None),
         (7, at(2), 64.9, 1.0, 81.0, 100.0, None, None)],
    )
    labels = frame("entity_id bigint, label int", [(8, 1)])
    (entity, plain, trend, label), = rows(summaries.patient_summaries(df, labels))
    assert label is None
    assert plain == (
        "Patient is a 64-year-old male. Over the first 48 hours:\n"
        "- HR ranged from 80.00 to 100.00, avg: 100.00, last: 100.00\n"
        "- Temp ranged from 37.00 to 37.00, avg: 37.00, last: 37.00"
    )
    assert trend == (
        "Patient is a 64-year-old male, weights 81.0 kg. Over the first 48 hours:\n"
        "- HR ranged from 80.00 to 100.00, shows a trend of ↑. avg: 100.00, last: 100.00"
    )
    mean = summaries.entity_summaries(df, true_mean=True).first().summary_statistical
    assert "avg: 90.04, last: 100.00" in mean


def test_prompts(frame):
    train = frame("entity_id bigint, text string, label int", [(1, "a", 1), (2, "b", 0), (3, "c", 1), (4, "d", 0)])
    context = prompts.few_shot_context(train, "text", "label", 4).first().context
    parts = context.split("\n\n")
    assert context.startswith("### Examples\nInput:\n") and len(parts) == 4
    assert {p.removeprefix("### Examples\n") for p in parts} == {
        "Input:\na\nAnswer: 10/10", "Input:\nb\nAnswer: 1/10", "Input:\nc\nAnswer: 10/10", "Input:\nd\nAnswer: 1/10"
    }
    binary = prompts.few_shot_context(train, "text", "label", 1, mode="binary").first().context
    assert binary[-1] in "01" and not binary.endswith("/10")
    asked = train.select(
        prompts.user_prompt(F.col("text")).alias("zero"), prompts.user_prompt(F.col("text"), F.lit("CTX")).alias("few")
    ).first()
    assert asked.zero == "Input:\na\nAnswer:"
    assert asked.few == "CTX\n\n### Task \nInput:\na\nAnswer:"


class Flaky:
    """Fails on its first call."""

    def __init__(self):
        self.calls = 0

    def __call__(self, system, prompt):
        self.calls += 1
        if self.calls == 1:
            raise RuntimeError("not yet")
        return prompt.upper()


def test_model_calls_keep_keys_and_are_repeated(frame):
    df = frame("entity_id bigint, system string, prompt string", [(i, "s", f"p{i}") for i in range(20)]).coalesce(1)
    got = rows(prompts.batch_infer(df, Flaky, ["entity_id"], threads=1))
    assert got == [(i, f"P{i}") for i in range(20)]


def test_prompt_sweep_covers_all_settings(frame):
    data = [(i, f"level {i % 10 * 10}", f"trend {i % 7 * 10}", int(i % 10 > 5)) for i in range(40)]
    df = frame("entity_id bigint, one string, two string, label int", data)
    table = prompts.prompt_sweep(df, df, ["one", "two"], "label", RuleClient)
    got = {(r.text, r.shots, r.mode): r for r in table.collect()}
    assert len(got) == 8 and all(r.n == 40 for r in got.values())
    assert got["one", "zero-shot", "score"].auroc == 1.0


def test_tokens(frame):
    df = frame(PANEL, [(1, at(0), 1.0, None), (1, at(12), 3.0, 40.0), (2, at(0), 5.0, 40.0)])
    labels = frame("entity_id bigint, label int", [(1, 1)])
    triples, index = sequences.build_tzv(df, labels, ["HR", "Temp"], "2024-01-01 00:00:00", 24)
    assert index == {"HR": 0, "Temp": 1}
    assert rows(triples) == [(1, 0.0, 0, 0.0, 1), (1, 0.5, 0, 0.5, 1), (1, 0.5, 1, 0.0, 1), (2, 0.0, 0, 1.0, None), (2, 0.0, 1, 0.0, None)]


def test_sequences_are_padded_and_continued(frame):
    df = frame(PANEL, [(1, at(i), float(i), 1.0) for i in (2, 0, 1)] + [(2, at(5), 9.0, None)])
    got = {r.entity_id: r for r in sequences.build_sequences(df, ["HR", "Temp"]).collect()}
    assert got[1].sequence == [[0.0, 1.0], [1.0, 1.0], [2.0, 1.0]]
    assert got[2].sequence == [[9.0, 0.0], [0.0, 0.0], [0.0, 0.0]] and got[2].length == 1
    parts = rows(sequences.build_sequences(df, ["HR"], pad_to=2, chunk_hours=1), "entity_id", "segment")
    assert [(r[0], r[1], r[2], r[3]) for r in parts] == [
        (1, 0, 2, [[0.0], [1.0]]), (1, 1, 1, [[2.0], [0.0]]), (2, 0, 1, [[9.0], [0.0]])
    ]


def test_pooling_and_channels(frame):
    df = frame("entity_id bigint, variable string, x double, y double", [(1, "a", 1.0, 2.0), (1, "b", 3.0, 6.0), (2, "b", 5.0, 5.0)])
    vecs = df.select("entity_id", "variable", F.array("x", "y").alias("embedding"))
    assert rows(vectors.mean_pool(vecs, ["entity_id"])) == [(1, [2.0, 4.0]), (2, [5.0, 5.0])]
    assert rows(vectors.concat_channels(vecs, ["a", "b"], 2)) == [(1, [1.0, 2.0, 3.0, 6.0]), (2, [0.0, 0.0, 5.0, 5.0])]
    wide = vectors.embeddings_to_wide(vecs, 2, ["entity_id", "variable"])
    assert rows(vectors.embeddings_from_wide(wide, ["entity_id", "variable"])) == rows(vecs)


@pytest.mark.parametrize("context", [8192, 2])
def test_series_embedding_keeps_every_reading(frame, context):
    df = frame(PANEL, [(1, at(i), float(i), None) for i in range(5)] + [(2, at(0), None, None)])
    made = vectors.embed_series(df, ["HR", "Temp"], StatisticsEmbedder, context=context, chunk_hours=2)
    assert sum(len(r.tokens) for r in made.collect()) == 5
    pooled = vectors.patient_embedding(df, ["HR", "Temp"], StatisticsEmbedder, context=context)
    (entity, vector), = rows(pooled)
    assert entity == 1 and vector[0] == 2.0
    padded = vectors.patient_embedding(df, ["HR", "Temp"], StatisticsEmbedder, width=5)
    assert dict(rows(padded))[2] == [0.0] * 5


def test_text_embedding(frame):
    df = frame("entity_id bigint, text string", [(1, "a b"), (2, "b a"), (3, None)])
    got = {r[0]: np.array(r[1]) for r in rows(vectors.embed_text(df, "text", HashingEmbedder))}
    assert np.allclose(got[1], got[2]) and np.linalg.norm(got[1]) == pytest.approx(1) and not got[3].any()


def test_models(frame):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(120, 3))
    y = (x[:, 0] + 0.3 * rng.normal(size=120) > 0).astype(int)
    df = frame("entity_id bigint, a double, b double, c double, label int", [(i, *map(float, v), int(k)) for i, (v, k) in enumerate(zip(x, y))])
    table = models.to_features(df, ["a", "b", "c"], ["entity_id", "label"])
    logistic = models.fit_logistic(table)
    w, b = logistic.coefficients.toArray(), logistic.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    # at the optimum the summed loss balances the penalty (C = 1)
    assert (x * (p - y)[:, None]).sum(0) + w == pytest.approx(np.zeros(3), abs=1e-2)
    scored = models.predict_positive(logistic, table, ["entity_id", "label"])
    assert scored.where("score between 0 and 1").count() == 120
    folds = models.stratified_folds(table, folds=5)
    sizes = [r[0] for r in folds.groupBy("fold", "label").count().select("count").where("label = 1").collect()]
    assert max(sizes) - min(sizes) <= 1
    model, codes = models.pca_representation(table, 2, ["entity_id"])
    centred = x - x.mean(0)
    singular = np.linalg.svd(centred, compute_uv=False)
    assert models.reconstruction_error(model, codes).first().mse == pytest.approx(singular[2] ** 2 / 120 / 3)
    sweep = models.label_scarcity_sweep(table, {"all": table}, [20, 60])
    assert {(r.sample_size, r.n) for r in sweep.collect()} == {(20, 120), (60, 120)}


def test_headers_state_what_is_missing_and_numbers_have_no_exponent(frame):
    from pyspark.sql import functions as F

    from cohort_spark.functions.numeric import two_decimals
    from cohort_spark.operators.summaries import _plain_number, entity_summaries

    df = frame(
        "entity_id int, ts timestamp_ntz, Age double, Gender double, Weight double, HR double",
        [(1, "2024-01-01 00:00:00", None, 1.0, None, 80.0), (2, "2024-01-01 00:00:00", 70.0, 0.0, 81.5, 60.0)],
    )
    got = {r.entity_id: r for r in entity_summaries(df, ["HR"]).collect()}
    assert got[1].summary_statistical.count("unknown") == 1 and got[1].summary_trend.count("unknown") == 2
    assert "unknown" not in got[2].summary_trend and "81.5" in got[2].summary_trend
    numbers = frame("x double", [(1e8,), (0.00025,), (3.0,), (1e30,)])
    text = [r.t for r in numbers.select(_plain_number(F.col("x")).alias("t")).collect()]
    assert text[:3] == ["100000000.0", "0.00025", "3.0"] and "E" not in text[3]
    assert numbers.select(two_decimals(F.col("x")).alias("t")).collect()[3].t.startswith("1000000000000000")
