"""The corpus pipeline: five stages over ``documents``, each on all that the one before kept.

Each stage is a function of (spark, docs, sf_dir) and is written as Parquet and read again as the next one's ``docs``.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_spark.llm import near_dup, packing, secrets, substrings, toxicity
from cohort_spark.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of ``documents``, with the length of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted to be toxic."""
    return toxicity.drop_toxic(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return near_dup.drop_near_duplicates(docs.select(*COLUMNS))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document with a smaller id has too.

    A text that has none stays as it is; of others the words left are kept, one space between them.
    """
    cut = substrings.remove_repeats(docs.select(*COLUMNS))
    return _documents(cut.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets masked."""
    return _documents(secrets.mask(docs.select(*COLUMNS)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substrings", cut_repeats),
    ("secrets", mask_secrets),
    ("packing", pack),
]

ORACLE_SQL = None  # toxicity is a trained score: tests hold each stage against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each stage's result is a table below the shared folder."""
    folder = scratch_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir.rstrip("/"))
        if k + 1 < len(STAGES):
            path = f"{folder}/{k}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
