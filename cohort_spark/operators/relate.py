"""Joins by key.  Sides are never broadcast by hint: sizes are Spark's to check, also at run time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.plans.chunks import attach


def attach_labels(df: DataFrame, labels: DataFrame, how: str = "left", entity: str = "entity_id") -> DataFrame:
    """Labels by entity.  ``left`` keeps unlabelled rows with null, ``inner`` skips them."""
    return attach(df, labels, [entity], how)


def unlabelled(df: DataFrame, labels: DataFrame, entity: str = "entity_id") -> DataFrame:
    """Rows an inner label join would skip."""
    return df.join(labels.select(entity), entity, "left_anti")


def map_static(df: DataFrame, static: DataFrame, cols: Sequence[str], entity: str = "entity_id") -> DataFrame:
    """Per-entity values written over the columns of all rows, column order kept."""
    base = df.drop(*cols)
    order = [*df.columns, *[c for c in cols if c not in df.columns]]
    return attach(base, static.select(entity, *cols), [entity]).select(*order)


def union_entities(frames: Sequence[DataFrame]) -> DataFrame:
    """Frames stacked by column name; a column a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def expand_settings(df: DataFrame, settings: Mapping[str, Sequence]) -> DataFrame:
    """Every row once per combination of the listed settings; the lists are literals, so this is a projection."""
    out = df
    for name, values in settings.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out
