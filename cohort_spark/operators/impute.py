"""Filling gaps: static view, flags, forward fill, interpolation in time, column medians."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_spark.functions.time import seconds_between
from cohort_spark.operators.quality import replace_columns
from cohort_spark.operators.reshape import melt
from cohort_spark.plans.chunks import CHUNK_HOURS, CHUNK_ROWS, Chunks, attach, chunks, nearest_known, place_of, with_parameters
from cohort_spark.plans.runs import exact_quantiles

def static_view(df: DataFrame, cols: Sequence[str], order: Sequence[str], entity: str = "entity_id") -> DataFrame:
    """First non-null value per entity and column."""

    def first(c: str) -> Column:
        return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), place_of(order))).alias(c)

    return df.groupBy(entity).agg(*[first(c) for c in cols])


def any_flag_to_static(
    df: DataFrame, col: str, entity: str = "entity_id", flag=1, only_nulls: bool = False
) -> DataFrame:
    """1 on all rows of an entity that carries the flag in some row, else 0.

    ``only_nulls`` keeps the readings and fills the other rows.
    """
    flags = df.groupBy(entity).agg(F.max(F.coalesce((F.col(col) == flag).cast("int"), F.lit(0))).alias("__flag"))
    new = F.coalesce(F.col(col).cast("int"), F.col("__flag")) if only_nulls else F.col("__flag")
    return replace_columns(attach(df, flags, [entity]), {col: new}).drop("__flag")


def forward_fill(
    df: DataFrame,
    cols: Sequence[str],
    order: Sequence[str],
    entity: str = "entity_id",
    chunk_hours: float | None = CHUNK_HOURS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The last reading up to each row, per entity.  ``order`` starts with the time column.

    Histories are counted per slice of ``chunk_hours`` and cut into chunks of about ``chunk_rows`` rows (see
    ``plans.chunks``); give ``chunk_hours=None`` for panels whose rows per entity are bounded.
    """
    known = nearest_known(df, [entity], order, cols, chunks(chunk_hours, chunk_rows))
    filled = replace_columns(known, {c: F.col(f"{c}__prev")["v"] for c in cols})
    return filled.select(*df.columns)


def _between(t: Column, pt: Column, pv: Column, nt: Column, nv: Column) -> Column:
    """Linear in time between two knots; the nearer knot alone where the other is missing."""
    rise = F.try_divide((nv - pv) * seconds_between(pt, t), seconds_between(pt, nt))
    return F.when(pv.isNull(), nv).when(nv.isNull(), pv).otherwise(pv + F.coalesce(rise, F.lit(0.0)))


def interpolate_time(
    df: DataFrame,
    cols: Sequence[str],
    ts: str = "ts",
    entity: str = "entity_id",
    scope: str = "entity",
    chunk_hours: float | None = CHUNK_HOURS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Fill nulls linearly in time, and with the nearest reading before the first and after the last.

    ``scope="entity"`` looks at the history of the entity only.  ``scope="global"`` uses the readings of all
    entities on one time axis, so a gap is filled from other entities: values leak between them.  Where several
    entities read at the same time, a hit on that time takes the last by entity id, and a gap starts at
    the last and ends at the first.
    """
    if scope == "global":
        return _interpolate_globally(df, cols, ts, entity, chunks(chunk_hours, chunk_rows))
    if scope != "entity":
        raise ValueError(f"unknown scope {scope!r}")
    known = nearest_known(df, [entity], [ts], cols, chunks(chunk_hours, chunk_rows), ahead=True)

    def filled(c: str) -> Column:
        prev, nxt = F.col(f"{c}__prev"), F.col(f"{c}__next")
        gap = _between(F.col(ts), prev["o0"], prev["v"], nxt["o0"], nxt["v"])
        return F.coalesce(F.col(c), gap)

    return replace_columns(known, {c: filled(c) for c in cols}).select(*df.columns)


def _interpolate_globally(
    df: DataFrame, cols: Sequence[str], ts: str, entity: str, cut: Chunks | None
) -> DataFrame:
    """One knot row per time stamp (pre-aggregated), neighbours among the knots, joined back on the time stamp."""

    def at_time(c: str, pick) -> Column:
        return pick(F.col(c), F.when(F.col(c).isNotNull(), F.col(entity)))

    knots = df.groupBy(ts).agg(
        *[F.struct(at_time(c, F.min_by).alias("lo"), at_time(c, F.max_by).alias("hi")).alias(c) for c in cols]
    )
    knots = knots.select(ts, *[F.when(F.col(c)["lo"].isNotNull(), F.col(c)).alias(c) for c in cols])
    axis = knots.withColumn("__axis", F.lit(0))
    known = nearest_known(axis, ["__axis"], [ts], cols, cut, ahead=True)

    def fill(c: str) -> Column:
        prev, nxt = F.col(f"{c}__prev"), F.col(f"{c}__next")
        gap = _between(F.col(ts), prev["o0"], prev["v"]["hi"], nxt["o0"], nxt["v"]["lo"])
        return F.coalesce(F.col(c)["hi"], gap).alias(f"__fill_{c}")

    fills = known.select(ts, *[fill(c) for c in cols])
    joined = attach(df, fills, [ts])
    new = {c: F.coalesce(F.col(c), F.col(f"__fill_{c}")) for c in cols}
    return replace_columns(joined, new).select(*df.columns)


def impute_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: +inf to the largest and -inf to the smallest finite value, missing to the median, all missing to 0."""
    infinite = F.lit(float("inf"))

    def finite(c: str) -> Column:
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        return F.when(F.abs(x) < infinite, x)

    tidy = melt(df.select(*[finite(c).alias(c) for c in cols]), [], cols)
    found = exact_quantiles(tidy, "value", {"low": 0.0, "median": 0.5, "high": 1.0}, ["variable"])
    row = found.agg(
        *[F.max(F.when(F.col("variable") == c, F.struct("low", "median", "high"))).alias(c) for c in cols]
    )

    def filled(c: str) -> Column:
        x, fit = F.col(c).cast("double"), F.col(f"__fit.{c}")
        known = F.when(x == infinite, fit["high"]).when(x == -infinite, fit["low"]).otherwise(finite(c))
        return F.coalesce(known, fit["median"], F.lit(0.0))

    return replace_columns(with_parameters(df, row, "__fit"), {c: filled(c) for c in cols}).select(*df.columns)
