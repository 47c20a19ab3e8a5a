"""All registered queries, with the SQL each must agree with."""

from cohort_spark.catalog import cleaning, filling, learning, shaping, statistics, texts  # noqa: F401
from cohort_spark.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
