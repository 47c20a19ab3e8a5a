"""A table of model answers, so that no prompt is asked twice."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_spark.operators.prompts import batch_infer

STORED = "prompt_key string, answer string"


def prompt_key(system: str = "system", prompt: str = "prompt") -> Column:
    """What an answer is stored under: a hash of both texts and of where one ends."""
    return F.sha2(F.to_json(F.struct(F.col(system).alias("s"), F.col(prompt).alias("p"))), 256)


def stored_answers(spark: SparkSession, store: str) -> DataFrame:
    """(prompt_key, answer): what the folder ``store`` holds so far; runs that overlap may have stored a key twice."""
    try:
        found = spark.read.schema(STORED).parquet(store)
    except AnalysisException:
        return spark.createDataFrame([], STORED)
    return found.groupBy("prompt_key").agg(F.min("answer").alias("answer"))


def ask_missing(
    df: DataFrame,
    make_client: Callable[[], Callable[[str, str], str]],
    store: str,
    system: str = "system",
    prompt: str = "prompt",
    partitions: int | None = None,
    **options,
) -> None:
    """Ask what ``store`` has no answer to, each different pair of system text and prompt once, and add the answers.

    ``partitions`` is the number of tasks that ask; without it the shuffle decides.  A task that is lost asks its share again;
    answers that were written stay.  Rows without a prompt aren't asked.
    """
    spark = df.sparkSession
    pairs = df.where(F.col(prompt).isNotNull()).select(prompt_key(system, prompt).alias("prompt_key"), F.col(system).alias("system"), F.col(prompt).alias("prompt"))
    pairs = pairs.groupBy("prompt_key").agg(F.any_value("system").alias("system"), F.any_value("prompt").alias("prompt"))
    missing = pairs.join(stored_answers(spark, store), "prompt_key", "left_anti")
    if partitions is not None:
        missing = missing.repartition(partitions, "prompt_key")
    batch_infer(missing, make_client, ["prompt_key"], **options).write.mode("append").parquet(store)


def with_answers(df: DataFrame, store: str, system: str = "system", prompt: str = "prompt", out: str = "answer") -> DataFrame:
    """``df`` with the stored answer of each row, null where there is none."""
    stored = stored_answers(df.sparkSession, store).withColumnRenamed("answer", "__answer")
    keyed = df.drop(out).withColumn("prompt_key", F.when(F.col(prompt).isNotNull(), prompt_key(system, prompt)))
    return keyed.join(stored, "prompt_key", "left").withColumnRenamed("__answer", out).drop("prompt_key")


def answered(
    df: DataFrame, make_client: Callable[[], Callable[[str, str], str]], store: str, keys: Sequence[str], partitions: int | None = None, **options
) -> DataFrame:
    """``keys`` and the answer to ``system`` and ``prompt`` of every row, from the store or newly asked."""
    ask_missing(df, make_client, store, partitions=partitions, **options)
    return with_answers(df, store).select(*keys, "answer")
