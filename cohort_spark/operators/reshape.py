"""Long to wide and back, hour grid, column order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_spark.functions.numeric import bin_centre
from cohort_spark.functions.time import ceil_to_hour, seconds_between
from cohort_spark.plans.chunks import CHUNK_HOURS, CHUNK_ROWS, chunks, lagged


def discover_variables(df: DataFrame, variable: str = "variable") -> list[str]:
    """The variable names that occur, sorted.  One job; pass the list on so that later plans stay static."""
    return [r[0] for r in df.select(variable).where(F.col(variable).isNotNull()).distinct().orderBy(variable).collect()]


def pivot_first(
    df: DataFrame,
    index: Sequence[str],
    variables: Sequence[str],
    tie: str,
    variable: str = "variable",
    value: str = "value",
) -> DataFrame:
    """Long to wide: per index key and variable the first non-null value in the order of ``tie``.

    One partial and one final aggregate; an index key appears only if it has a reading of a listed variable.
    """

    def first(name: str) -> Column:
        return F.min_by(F.col(value), F.when(F.col(variable) == name, F.col(tie))).alias(name)

    readings = df.where(F.col(variable).isin(list(variables)) & F.col(value).isNotNull())
    return readings.groupBy(*index).agg(*[first(v) for v in variables])


def discretize(
    df: DataFrame, variables: Sequence[str], entity: str = "entity_id", ts: str = "ts", out: str | None = None
) -> DataFrame:
    """Mean of every variable per entity and started hour, nulls left out."""
    hour = out or ts
    return df.groupBy(entity, ceil_to_hour(F.col(ts)).alias(hour)).agg(*[F.avg(v).alias(v) for v in variables])


def melt(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "variable", value: str = "value"
) -> DataFrame:
    """Wide to long; null cells stay."""
    cells = df.select(*ids, *[F.col(v).cast("double").alias(v) for v in values])
    return cells.unpivot(list(ids), list(values), name, value)


def feature_index(features: Sequence[str]) -> dict[str, int]:
    return {f: i for i, f in enumerate(features)}


def index_features(df: DataFrame, features: Sequence[str], name: str = "variable", out: str = "Z") -> DataFrame:
    """Replace feature names by their position in ``features``."""
    lookup = F.array_position(F.array(*[F.lit(f) for f in features]), F.col(name))
    index = F.when(lookup > 0, lookup - 1).cast("int")
    return df.select(*[index.alias(out) if c == name else F.col(c) for c in df.columns])


def reorder_columns(df: DataFrame, first: Sequence[str], static: Sequence[str]) -> DataFrame:
    """Keys, then static columns, then all others in their present order."""
    rest = [c for c in df.columns if c not in static and c not in first]
    return df.select(*first, *static, *rest)


def recast(df: DataFrame, casts: Mapping[str, str], drop: Sequence[str] = ()) -> DataFrame:
    """Drop columns and cast others in one projection."""
    kept = [c for c in df.columns if c not in drop]
    return df.select(*[F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c) for c in kept])


def concat_columns(df: DataFrame, *blocks: Mapping[str, Column], keep: Sequence[str] = ()) -> DataFrame:
    """Kept columns and blocks of computed columns side by side: one projection, no positional join."""
    return df.select(*keep, *[col.alias(name) for block in blocks for name, col in block.items()])


def split_xy(
    df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Feature frame and label frame.  Both carry the keys, which is what relates them."""
    return df.select(*keys, *features), df.select(*keys, label)


def fill_missing_hours(
    df: DataFrame,
    horizon_hours: int = 48,
    entity: str = "entity_id",
    ts: str = "ts",
    chunk_hours: float | None = CHUNK_HOURS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Insert null rows so that no entity has a gap of two hours or more before its horizon.

    Between consecutive rows two or more hours apart, hourly rows from one hour after the first to one hour
    before the second.  After a last row at least one hour before ``first + horizon``, hourly rows up to there.
    """
    values = [c for c in df.columns if c not in (entity, ts)]
    hour, empty = F.expr("interval 1 hour"), {c: F.lit(None).cast(t) for c, t in df.dtypes if c in values}
    times = df.select(entity, F.col(ts).cast("timestamp_ntz").alias(ts))
    gaps = (
        lagged(times, [entity], [ts], [ts], [1], chunks(chunk_hours, chunk_rows), suffix="__before")
        .withColumn("__from", F.col(f"{ts}__before1"))
        .where(seconds_between(F.col("__from"), F.col(ts)) >= 7200)
        .select(entity, (F.col("__from") + hour).alias("__from"), (F.col(ts) - hour).alias("__to"))
    )
    end = F.col("__first") + F.make_dt_interval(F.lit(0), F.lit(int(horizon_hours)))
    tails = (
        times.groupBy(entity)
        .agg(F.min(ts).alias("__first"), F.max(ts).alias("__last"))
        .where(seconds_between(F.col("__last"), end) >= 3600)
        .select(entity, (F.col("__last") + hour).alias("__from"), end.alias("__to"))
    )
    added = gaps.unionByName(tails).select(entity, F.explode(F.sequence("__from", "__to", hour)).alias(ts))
    return df.withColumn(ts, F.col(ts).cast("timestamp_ntz")).unionByName(added.withColumns(empty))


def binned_counts(df: DataFrame, col: str, width: float, by: Sequence[str] = ()) -> DataFrame:
    """Rows per bin of ``width``; nulls left out."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(*by, bin_centre(F.col(col).cast("double"), width).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
