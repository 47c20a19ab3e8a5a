"""The hourly panel over a stream of readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOUR_STEP = "1 microsecond"


def discretize_stream(
    readings: DataFrame,
    variables: Sequence[str],
    delay: str = "2 hours",
    entity: str = "entity_id",
    ts: str = "ts",
    variable: str = "variable",
    value: str = "value",
) -> DataFrame:
    """Mean of every variable per entity and started hour, from long readings.

    Of several readings of a variable at one time the first that arrives counts, as in the batch panel.
    An hour is emitted once no reading later than ``delay`` can belong to it; state is one row per open
    entity and hour, and one per reading of the open hours.  Windows hold the time stamps up to and including the full hour they are named after.
    """
    instant = F.col(ts).cast("timestamp")
    # moved back by the smallest step, a reading on the full hour falls into the window that ends there
    timed = readings.withColumn("__at", instant - F.expr(f"interval {HOUR_STEP}")).withWatermark("__at", delay)
    timed = timed.where(F.col(value).isNotNull()).dropDuplicates([entity, "__at", variable])
    means = [F.avg(F.when(F.col(variable) == v, F.col(value))).alias(v) for v in variables]
    hours = timed.groupBy(entity, F.window("__at", "1 hour")).agg(*means)
    return hours.select(entity, F.col("window.end").cast("timestamp_ntz").alias(ts), *variables)
