"""Registration of queries with the SQL that must give the same table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {}


class Tables:
    """The tables of a folder as attributes, each a lazy scan."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under ``name``, with its SQL where SQL can say it."""

    def register(build):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        BUILDERS[name] = build
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
