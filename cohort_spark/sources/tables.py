"""CSV tables: outcomes, texts, embeddings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_spark.operators.vectors import embeddings_from_wide, embeddings_to_wide

TEXT_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def load_outcomes(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: str = "RecordID bigint, `SAPS-I` int, SOFA int, Length_of_stay int, Survival int, `In-hospital_death` int",
    entity: str = "RecordID",
    label: str = "In-hospital_death",
) -> DataFrame:
    """Entity and label of the outcome files; only these two columns are parsed."""
    rows = spark.read.schema(schema).csv(paths, header=True)
    return rows.select(F.col(entity).cast("bigint").alias("entity_id"), F.col(f"`{label}`").cast("int").alias("label"))


def write_text_csv(df: DataFrame, path: str) -> None:
    """Texts with line breaks and quotes as CSV."""
    df.write.mode("overwrite").options(**TEXT_OPTIONS, quoteAll="true", emptyValue="", nullValue="\\N").csv(path)


def read_text_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A multi-line CSV can't be split, so each file is read by one task: write it in many files, or use Parquet."""
    return spark.read.schema(schema).options(**TEXT_OPTIONS, emptyValue="", nullValue="\\N").csv(path)


def write_embeddings_csv(df: DataFrame, path: str, width: int, keep: Sequence[str], vector: str = "embedding") -> None:
    """The kept columns, then one column per dimension."""
    wide = embeddings_to_wide(df, width, keep, vector)
    wide.write.mode("overwrite").csv(path, header=True)


def read_embeddings_csv(
    spark: SparkSession, path: str, width: int, keep: dict[str, str], vector: str = "embedding"
) -> DataFrame:
    """``keep`` maps the kept columns, which come first in the file, to their types."""
    columns = [*[f"`{c}` {t}" for c, t in keep.items()], *[f"`{i}` float" for i in range(width)]]
    rows = spark.read.schema(", ".join(columns)).csv(path, header=True)
    return embeddings_from_wide(rows, list(keep), vector)
