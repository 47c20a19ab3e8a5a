"""Data-quality rules, profiles and checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_spark.functions.rules import MEASUREMENT_RULES, apply_rules
from cohort_spark.plans.chunks import attach, place_of


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def replace_columns(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """Columns rewritten in place, in one projection."""
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def clean(df: DataFrame, rules: Mapping[str, Sequence[tuple]] = MEASUREMENT_RULES) -> DataFrame:
    """An ordered rule list per column; columns the frame lacks are passed over."""
    return replace_columns(df, {c: apply_rules(F.col(c), r) for c, r in rules.items() if c in df.columns})


def sentinel_to_null(df: DataFrame, cols: Sequence[str], sentinel=-1) -> DataFrame:
    return clean(df, {c: [("null_if_equals", sentinel)] for c in cols})


def sentinel_violations(
    df: DataFrame, cols: Sequence[str], order: Sequence[str], entity: str = "entity_id", sentinel=-1
) -> DataFrame:
    """Entities with the sentinel in a row after their first, and which columns are clean.

    Compares the last place the sentinel takes with the first place of the entity: two aggregates that
    combine on the map side, instead of numbering the rows of an entity.
    """
    place = place_of(order)
    checks = [
        F.coalesce(F.max(F.when(F.col(c) == sentinel, place)) <= F.min(place), F.lit(True)).alias(f"{c}_first_only")
        for c in cols
    ]
    return df.groupBy(entity).agg(*checks).where(_any([~F.col(f"{c}_first_only") for c in cols]))


def null_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Nulls and missing rate of every column, from one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(c)).alias(c) for c in cols])
    return counts.unpivot(["rows"], list(cols), "column", "known").select(
        "column",
        (F.col("rows") - F.col("known")).alias("nulls"),
        F.try_divide((F.col("rows") - F.col("known")).cast("double"), F.col("rows").cast("double")).alias("missing_rate"),
    )


def domain_check(df: DataFrame, domains: Mapping[str, Sequence]) -> DataFrame:
    """Per column whether all non-null values lie in the given set, and how many do not."""
    outside = df.agg(*[F.count_if(~F.col(c).isin(list(d))).alias(c) for c, d in domains.items()])
    return outside.unpivot([], list(domains), "column", "outside").select(
        "column", "outside", (F.col("outside") == 0).alias("in_domain")
    )


def varying_entities(df: DataFrame, col: str, entity: str = "entity_id") -> DataFrame:
    """Entities for which the column takes more than one value."""
    return (
        df.groupBy(entity)
        .agg(F.min(col).alias("low"), F.max(col).alias("high"))
        .where(F.col("low") != F.col("high"))
    )


def negative_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.where(_any([F.col(c) < 0 for c in cols]))


def singleton_entities(df: DataFrame, entity: str = "entity_id") -> DataFrame:
    return df.groupBy(entity).agg(F.count(F.lit(1)).alias("n")).where("n = 1")


def entities_in(df: DataFrame, ids: DataFrame | Sequence, entity: str = "entity_id") -> DataFrame:
    """Rows of the listed entities; a frame of ids is semi-joined, a short list becomes a pushed-down filter."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select(entity), entity, "left_semi")
    return df.where(F.col(entity).isin(list(ids)))


def null_by_offender_set(
    df: DataFrame, static: DataFrame, offends: Column, col: str, entity: str = "entity_id"
) -> DataFrame:
    """Null the column on all rows of the entities whose static row offends."""
    offenders = static.where(offends).select(entity).distinct().withColumn("__offends", F.lit(True))
    flagged = attach(df, offenders, [entity])
    return replace_columns(flagged, {col: F.when(F.col("__offends").isNull(), F.col(col))}).drop("__offends")


def extreme_records(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(condition)


def history_of_extremes(df: DataFrame, condition: Column, entity: str = "entity_id") -> DataFrame:
    """All rows of every entity that has an extreme row."""
    return entities_in(df, df.where(condition).select(entity).distinct(), entity)


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(subset) if subset else None)


def last_rows(df: DataFrame, order: Sequence[str], entity: str = "entity_id", last: bool = True) -> DataFrame:
    """The last (or first) row of every entity, by an aggregate that combines on the map side."""
    pick = F.max_by if last else F.min_by
    chosen = df.groupBy(entity).agg(pick(F.struct(*df.columns), place_of(order)).alias("__row"))
    return chosen.select("__row.*")


def entities_with_null_last_row(
    df: DataFrame, cols: Sequence[str], order: Sequence[str], entity: str = "entity_id"
) -> DataFrame:
    return last_rows(df, order, entity).where(_any([F.col(c).isNull() for c in cols]))


def reconcile_cells(wide: DataFrame, long: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Non-null cells of the wide frame against rows of the long one: one row."""
    cells = wide.agg(*[F.count(F.col(c)).alias(c) for c in cols]).select(
        sum((F.col(c) for c in cols[1:]), F.col(cols[0])).alias("cells")
    )
    return long.agg(F.count(F.lit(1)).alias("long_rows")).select(
        cells.scalar().alias("wide_cells"), "long_rows", (cells.scalar() == F.col("long_rows")).alias("equal")
    )
