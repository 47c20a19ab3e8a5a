"""Stage tables: Parquet below one root, partitioned by split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The stages of a panel on its way from raw to final.
STAGES = ["initial", "before_imputation", "before_ffill", "before_backward", "before_scaling", "final"]


def _path(root: str, stage: str) -> str:
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}, known are {STAGES}")
    return f"{root.rstrip('/')}/stage={stage}"


def write_stage(df: DataFrame, root: str, stage: str, split: str | None = None) -> None:
    """Overwrite the stage for the splits in the frame (or for the one named); other splits stay."""
    rows = df if split is None else df.withColumn("split", F.lit(split))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("split").parquet(_path(root, stage))


def load_stage(spark: SparkSession, root: str, stage: str, split: str | None = None) -> DataFrame:
    """A stage, or one split of it; the filter prunes the other splits' files."""
    rows = spark.read.parquet(_path(root, stage))
    return rows if split is None else rows.where(F.col("split") == split)


def load_initial(spark: SparkSession, root: str, split: str | None = None) -> DataFrame:
    return load_stage(spark, root, "initial", split)


def load_before_imputation(spark: SparkSession, root: str, split: str | None = None) -> DataFrame:
    return load_stage(spark, root, "before_imputation", split)


def load_before_ffill(spark: SparkSession, root: str, split: str | None = None) -> DataFrame:
    return load_stage(spark, root, "before_ffill", split)


def load_before_backward(spark: SparkSession, root: str, split: str | None = None) -> DataFrame:
    return load_stage(spark, root, "before_backward", split)


def load_before_scaling(spark: SparkSession, root: str, split: str | None = None) -> DataFrame:
    return load_stage(spark, root, "before_scaling", split)


def load_final(
    spark: SparkSession, root: str, split: str | None = None, drop: Sequence[str] = ("ICUType",)
) -> DataFrame:
    """The final stage without the columns models do not use."""
    return load_stage(spark, root, "final", split).drop(*drop)
