"""Prompts, model calls and sweeps over prompt settings."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_spark.functions.answers import extract_score
from cohort_spark.operators.aggregate import sample_rows
from cohort_spark.operators.metrics import evaluate
from cohort_spark.operators.relate import expand_settings
from cohort_spark.plans.chunks import with_parameters
from cohort_spark.session import scratch_path

# The frame of a prompt and of its examples.
EXAMPLES_HEAD = "### Examples\n"
INPUT, ANSWER = "Input:\n", "\nAnswer:"
TASK = "\n\n### Task \n"

SYSTEM_PROMPTS = {
    "binary": (
        "You judge from a short summary of two days of measurements whether a patient will die in hospital. "
        "Reply with a single number, 0 or 1: 1 for a high risk of death, 0 for likely survival. Add nothing else."
    ),
    "score": (
        "You judge from a short summary of two days of measurements how likely a patient is to die in hospital. "
        "Reply with one whole number from 1 (very unlikely) to 10 (very likely). Add nothing else."
    ),
}


def few_shot_contexts(
    train: DataFrame,
    texts: Sequence[str],
    label: str,
    modes: Sequence[str] = ("binary", "score"),
    n: int = 3,
    seed: int = 42,
    key: str = "entity_id",
) -> DataFrame:
    """``n`` labelled examples as one text, in the order they are drawn, per text column and answer mode.

    One row; the columns are named ``{text}_{mode}``.  The examples are drawn once.
    """
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    grade = F.concat((F.col(label) * 9 + 1).cast("int").cast("string"), F.lit("/10"))

    def shown(text: str, mode: str) -> Column:
        answer = grade if mode == "score" else F.col(label).cast("string")
        return F.concat(F.lit(INPUT), F.col(text), F.lit(ANSWER + " "), answer).alias(f"{text}_{mode}")

    names = [f"{text}_{mode}" for text in texts for mode in modes]
    drawn = sample_rows(train.select(key, *texts, label), n, seed, key)
    examples = F.struct(order.alias("order"), F.col(key), *[shown(text, mode) for text in texts for mode in modes])
    listed = drawn.agg(F.array_sort(F.collect_list(examples)).alias("all"))  # n rows

    def joined(name: str) -> Column:
        body = F.array_join(F.transform("all", lambda e: e[name]), "\n\n")
        return F.regexp_replace(F.concat(F.lit(EXAMPLES_HEAD), body), r"^\s+|\s+$", "").alias(name)

    return listed.select(*[joined(name) for name in names])


def few_shot_context(
    train: DataFrame, text: str, label: str, n: int = 3, seed: int = 42, mode: str = "score", key: str = "entity_id"
) -> DataFrame:
    """The examples of one text column and mode: one row, column ``context``."""
    one = few_shot_contexts(train, [text], label, [mode], n, seed, key)
    return one.select(F.col(f"{text}_{mode}").alias("context"))


def user_prompt(text: Column, context: Column | None = None) -> Column:
    plain = F.concat(F.lit(INPUT), text, F.lit(ANSWER))
    if context is None:
        return plain
    with_examples = F.concat(context, F.lit(TASK), plain)
    return F.when(F.coalesce(context, F.lit("")) != "", with_examples).otherwise(plain)


def system_prompt(mode: Column | str, prompts: Mapping[str, str] = SYSTEM_PROMPTS) -> Column:
    if isinstance(mode, str):
        return F.lit(prompts[mode])
    out = F.lit(None).cast("string")
    for name, prompt in prompts.items():
        out = F.when(mode == name, prompt).otherwise(out)
    return out


def batch_infer(
    df: DataFrame,
    make_client: Callable[[], Callable[[str, str], str]],
    keys: Sequence[str],
    system: str = "system",
    prompt: str = "prompt",
    out: str = "answer",
    threads: int = 4,
    tries: int = 3,
) -> DataFrame:
    """Ask a model once per row; ``keys`` and the answer come back, so order does not matter.

    The client is built once per partition and called from a few threads, as calls to a model mostly wait.  A
    failed call is repeated with growing pauses and then fails the task, which Spark runs again.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()

        def ask(pair: tuple[str, str]) -> str:
            for attempt in range(tries):
                try:
                    return client(*pair)
                except Exception:
                    if attempt == tries - 1:
                        raise
                    time.sleep(0.1 * 2**attempt)

        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                answers = list(pool.map(ask, zip(batch[system], batch[prompt])))
                yield batch[list(keys)].assign(**{out: answers})

    kept = df.select(*keys, system, prompt)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.select(*keys).schema)
    return kept.mapInPandas(run, f"{schema}, `{out}` string")


def prompt_sweep(
    df: DataFrame,
    train: DataFrame,
    texts: Sequence[str],
    label: str,
    make_client: Callable[[], Callable[[str, str], str]],
    examples: int = 3,
    seed: int = 42,
    key: str = "entity_id",
    prompts: Mapping[str, str] = SYSTEM_PROMPTS,
    store: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Every text column, with and without examples, in both answer modes: AUROC and average precision of each.

    Rows are expanded by setting, asked through a table of answers (``operators.answers``) in the folder ``store``, scored and
    evaluated by setting.  Equal prompts are asked once, and a sweep over the same store asks only what is new; without a
    ``store`` it is a folder of this run.
    """
    from cohort_spark.operators.answers import answered

    modes = ["binary", "score"]
    rows = expand_settings(df, {"text": texts, "shots": ["few-shot", "zero-shot"], "mode": modes})
    shown = few_shot_contexts(train, texts, label, modes, examples, seed, key)
    rows = with_parameters(rows, shown, "__shown")
    chosen, context = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text in texts:
        chosen = F.when(F.col("text") == text, F.col(text)).otherwise(chosen)
        for mode in modes:
            fits = (F.col("shots") == "few-shot") & (F.col("text") == text) & (F.col("mode") == mode)
            context = F.when(fits, F.col(f"__shown.{text}_{mode}")).otherwise(context)
    settings = ["text", "shots", "mode"]
    asked = rows.select(
        key, label, *settings, system_prompt(F.col("mode"), prompts).alias("system"), user_prompt(chosen, context).alias("prompt")
    )
    store = store or scratch_path(df.sparkSession, "answers")
    answers = answered(asked, make_client, store, [key, label, *settings], partitions)
    score = F.when(F.col("mode") == "score", extract_score(F.col("answer"), "score")).otherwise(
        extract_score(F.col("answer"), "binary")
    )
    return evaluate(answers.withColumn("score", score), "score", label, settings)
