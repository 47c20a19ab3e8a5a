"""Raw observation files: CSV rows of elapsed time, parameter and value, one file per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_spark.functions.time import elapsed_to_timestamp
from cohort_spark.operators.reshape import discretize, pivot_first
from cohort_spark.plans.chunks import attach

SCHEMA = "Time string, Parameter string, Value double"
ID_VARIABLE = "RecordID"


def read_observations(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All files of the paths in one scan, with the file and the place of each row in it.

    ``line`` orders the rows of a file: the offset of the split, then the row within it.  It holds for files
    that are split as well.
    """
    rows = spark.read.schema(SCHEMA).csv(paths, header=True)
    line = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return rows.select("*", F.col("_metadata.file_path").alias("file"), line.alias("line"))


def extract_entity_id(
    df: DataFrame, key_variable: str = ID_VARIABLE, file: str = "file", variable: str = "Parameter", value: str = "Value",
    entity: str = "entity_id",
) -> DataFrame:
    """The value of each file's id row on all its other rows; rows of files without an id are left out."""
    is_id = F.col(variable) == key_variable
    ids = df.where(is_id & F.col(value).isNotNull()).groupBy(file).agg(F.min(value).cast("bigint").alias(entity))
    rows = df.where(~F.coalesce(is_id, F.lit(False)))
    return attach(rows, ids, [file], "inner").select(entity, *[c for c in df.columns if c != file])


def ingest_panel(
    spark: SparkSession, paths: str | Sequence[str], variables: Sequence[str], base_time: str
) -> DataFrame:
    """From files to the hourly panel: id, clock to time stamp, long to wide, mean per hour."""
    rows = extract_entity_id(read_observations(spark, paths))
    timed = rows.withColumn("ts", elapsed_to_timestamp(F.col("Time"), base_time))
    wide = pivot_first(timed, ["entity_id", "ts"], variables, "line", "Parameter", "Value")
    return discretize(wide, variables)
