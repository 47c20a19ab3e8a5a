"""Scaling with parameters fitted on one frame and applied to any other.

A fit is one row of parameters.  It reaches the projection as a scalar subquery, so applying it costs no
join and no driver round trip.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_spark.operators.quality import replace_columns
from cohort_spark.operators.reshape import melt
from cohort_spark.plans.chunks import with_parameters
from cohort_spark.plans.runs import exact_quantiles

# Measurements that are close to normally distributed and get the standard scaler.
NORMAL_COLUMNS = [
    "Height", "Weight", "Age", "Albumin", "Cholesterol", "DiasABP", "HCO3", "HCT", "HR", "Mg", "MAP", "Na",
    "NIDiasABP", "NIMAP", "NISysABP", "SysABP", "PaCO2", "PaO2", "Platelets", "RespRate", "Temp",
]


def _nonzero(width: Column) -> Column:
    return F.when(width == 0, F.lit(1.0)).otherwise(width)


def _fit_moments(fit_on: DataFrame, cols: Sequence[str]) -> DataFrame:
    return fit_on.agg(*[F.struct(F.avg(c).alias("at"), F.stddev_pop(c).alias("width")).alias(c) for c in cols])


def _fit_range(fit_on: DataFrame, cols: Sequence[str]) -> DataFrame:
    return fit_on.agg(*[F.struct(F.min(c).alias("at"), (F.max(c) - F.min(c)).alias("width")).alias(c) for c in cols])


def _fit_quartiles(fit_on: DataFrame, cols: Sequence[str], accuracy: int | None) -> DataFrame:
    if accuracy is not None:
        found = fit_on.agg(*[F.percentile_approx(c, [0.25, 0.5, 0.75], accuracy).alias(c) for c in cols])
        return found.select(
            *[F.struct(F.col(c)[1].alias("at"), (F.col(c)[2] - F.col(c)[0]).alias("width")).alias(c) for c in cols]
        )
    probs = {"q1": 0.25, "at": 0.5, "q3": 0.75}
    found = exact_quantiles(melt(fit_on, [], cols), "value", probs, ["variable"])
    centre = F.struct("at", (F.col("q3") - F.col("q1")).alias("width"))
    return found.agg(*[F.max(F.when(F.col("variable") == c, centre)).alias(c) for c in cols])


def _apply(df: DataFrame, *fits: DataFrame) -> DataFrame:
    out, new = df, {}
    for i, fit in enumerate(fits):
        out = with_parameters(out, fit, f"__fit{i}")
        for c in fit.columns:
            at, width = F.col(f"__fit{i}.{c}.at"), F.col(f"__fit{i}.{c}.width")
            new[c] = (F.col(c) - at) / _nonzero(width)
    return replace_columns(out, new).select(*df.columns)


def standard_scale(df: DataFrame, fit_on: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation; a constant column is only centred."""
    return _apply(df, _fit_moments(fit_on, cols))


def robust_scale(df: DataFrame, fit_on: DataFrame, cols: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """(x - median) / (Q3 - Q1).  Quartiles are exact; ``accuracy`` turns to approximate ones."""
    return _apply(df, _fit_quartiles(fit_on, cols, accuracy))


def minmax_scale(df: DataFrame, fit_on: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - min) / (max - min); a constant column becomes 0."""
    return _apply(df, _fit_range(fit_on, cols))


def scale_mixed(
    df: DataFrame,
    fit_on: DataFrame,
    normal: Sequence[str] = NORMAL_COLUMNS,
    skip: Sequence[str] = ("entity_id", "ts", "Gender"),
    accuracy: int | None = None,
) -> DataFrame:
    """The normal columns by mean and deviation, all other columns by median and quartiles, ``skip`` untouched."""
    cols = [c for c in df.columns if c not in skip]
    moments = [c for c in cols if c in normal]
    quartiles = [c for c in cols if c not in normal]
    fits = [_fit_moments(fit_on, moments)] if moments else []
    fits += [_fit_quartiles(fit_on, quartiles, accuracy)] if quartiles else []
    return _apply(df, *fits)


def scale_basic(
    df: DataFrame, fit_on: DataFrame, skip: Sequence[str] = ("entity_id", "ts", "Gender")
) -> DataFrame:
    """All columns but ``skip`` onto [0, 1]."""
    return minmax_scale(df, fit_on, [c for c in df.columns if c not in skip])


def minmax_scale_by_split(
    df: DataFrame, cols: Sequence[str], splits: Sequence[str], split: str = "split"
) -> DataFrame:
    """Each split onto its own [0, 1].  The splits are a short closed list: one parameter row serves all of them."""

    def ends(c: str, s: str) -> list[Column]:
        x = F.when(F.col(split) == s, F.col(c))
        return F.struct(F.min(x).alias("at"), (F.max(x) - F.min(x)).alias("width")).alias(s)

    fit = df.agg(*[F.struct(*[ends(c, s) for s in splits]).alias(c) for c in cols])

    def scaled(c: str) -> Column:
        out = F.lit(None).cast("double")
        for s in splits:
            at, width = F.col(f"__fit.{c}.{s}.at"), F.col(f"__fit.{c}.{s}.width")
            out = F.when(F.col(split) == s, (F.col(c) - at) / _nonzero(width)).otherwise(out)
        return out

    return replace_columns(with_parameters(df, fit, "__fit"), {c: scaled(c) for c in cols}).select(*df.columns)
