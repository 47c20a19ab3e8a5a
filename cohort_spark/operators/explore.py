"""Exploratory statistics: the tables behind summaries, bar charts, histograms, densities, boxes and tests."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_spark.operators.reshape import melt
from cohort_spark.plans.chunks import attach, attach_salted, with_parameters
from cohort_spark.plans.runs import exact_quantiles


def summary_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Min, quartiles, mean, max and null count of every column: one row per column.

    Moments and counts come from one pass over the wide frame; the exact quartiles from value counts.
    """
    stats = df.agg(
        *[
            F.struct(
                F.min(c).cast("double").alias("min"), F.avg(c).alias("mean"), F.max(c).cast("double").alias("max"),
                F.count_if(F.col(c).isNull()).alias("nulls"),
            ).alias(c)
            for c in cols
        ]
    )
    stats = stats.unpivot([], list(cols), "variable", "s").select("variable", "s.*")
    quartiles = exact_quantiles(melt(df, [], cols), "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, ["variable"])
    return attach(stats, quartiles, ["variable"]).select("variable", "min", "q1", "median", "mean", "q3", "max", "nulls")


def frequency_table(df: DataFrame, col: str, use_na: bool = True) -> DataFrame:
    rows = df if use_na else df.where(F.col(col).isNotNull())
    return rows.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """One row per probability."""
    named = {f"q{i}": p for i, p in enumerate(probs)}
    wide = exact_quantiles(df.select(col), col, named)
    long = wide.unpivot([], list(named), "name", "value")
    prob = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.substring("name", 2, 9).cast("int") + 1)
    return long.select(prob.alias("prob"), "value")


def kde(df: DataFrame, col: str, by: Sequence[str] = (), points: int = 512, cut: float = 0.0, exact: bool = False) -> DataFrame:
    """Gaussian density on an even grid over the data range, widened by ``cut`` bandwidths at both ends.

    Bandwidth by the rule of thumb 0.9 * min(sd, IQR / 1.34) * n^-0.2.  Equal values are counted first.  With ``exact``, the
    kernel of every distinct value is summed at every point, on the map side.  Without, a distinct value
    splits its weight over its two neighbours on a grid of ``points`` bins that reaches four bandwidths further, so what is
    summed from then on is at most ``points`` bins per group; kernels are summed at the bins and read off in between.
    """
    by = list(by)
    known = df.where(F.col(col).isNotNull()).select(*by, F.col(col).cast("double").alias("x"))
    moments = known.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"), F.min("x").alias("low"), F.max("x").alias("high")
    )
    quartiles = exact_quantiles(known, "x", {"q1": 0.25, "q3": 0.75}, by)
    iqr = (F.col("q3") - F.col("q1")) / 1.34
    spread = F.least(F.col("sd"), F.when(iqr > 0, iqr).otherwise(F.col("sd")))
    spread = F.when(spread > 0, spread).when(F.col("low") != 0, F.abs("low")).otherwise(1.0)
    width = F.lit(0.9) * spread * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    fit = _side_by_side(moments, quartiles, by, "n").withColumn("bw", width)
    fit = fit.select(
        *by, "n", "bw", (F.col("low") - cut * F.col("bw")).alias("low"), (F.col("high") + cut * F.col("bw")).alias("high")
    )
    counts = known.groupBy(*by, "x").agg(F.count(F.lit(1)).alias("w"))
    beside = _side_by_side(counts, fit, by, "x")
    if exact:
        grid = beside.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        at = F.col("low") + (F.col("high") - F.col("low")) * F.col("point") / (points - 1)
        z = (at - F.col("x")) / F.col("bw")
        part = F.col("w") * F.exp(-z * z / 2) / (F.col("n") * F.col("bw") * math.sqrt(2 * math.pi))
        return grid.groupBy(*by, "point").agg(F.max(at).alias("position"), F.sum(part).alias("density"))
    start = F.col("low") - 4 * F.col("bw")
    step = (F.col("high") + 4 * F.col("bw") - start) / (points - 1)
    place = (F.col("x") - start) / step
    placed = beside.withColumn("bin", F.floor(place)).withColumn("part", place - F.col("bin"))
    fitted = [F.max(c).alias(c) for c in ("n", "bw", "low", "high")]
    halves = F.array(
        F.struct(F.col("bin").alias("at"), F.sum(F.col("w") * (1 - F.col("part"))).alias("w")),
        F.struct((F.col("bin") + 1).alias("at"), F.sum(F.col("w") * F.col("part")).alias("w")),
    )
    bins = placed.groupBy(*by, "bin").agg(halves.alias("halves"), *fitted).withColumn("half", F.explode("halves"))
    bins = bins.groupBy(*by, F.col("half.at").alias("bin")).agg(F.sum("half.w").alias("w"), *fitted)
    grid = bins.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    z = (F.col("at") - F.col("bin")) * step / F.col("bw")
    part = F.col("w") * F.exp(-z * z / 2) / (F.col("n") * F.col("bw") * math.sqrt(2 * math.pi))
    heights = grid.groupBy(*by, "at").agg(F.sum(part).alias("y"), *fitted)
    curve = F.array_sort(F.collect_list(F.struct("at", "y")))["y"].alias("curve")  # one entry per point
    curves = heights.groupBy(*by).agg(curve, *fitted).withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    position = F.col("low") + (F.col("high") - F.col("low")) * F.col("point") / (points - 1)
    between = (position - start) / step
    left = F.floor(between).cast("int")
    y = [F.element_at("curve", left + i) for i in (1, 2)]
    return curves.select(*by, "point", position.alias("position"), (y[0] + (y[1] - y[0]) * (between - left)).alias("density"))


def _side_by_side(rows: DataFrame, one_per_group: DataFrame, by: Sequence[str], spread_by: str) -> DataFrame:
    """Group statistics next to the rows; without groups there is a single row of them, a scalar subquery."""
    if by:
        return attach_salted(rows, one_per_group, by, spread_by)
    return with_parameters(rows, one_per_group, "__fit").select(*rows.columns, "__fit.*")


def box_stats(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (last value within 1.5 IQR of the box) and outlier count per group."""
    by = list(by)
    known = df.where(F.col(col).isNotNull()).select(*by, F.col(col).cast("double").alias("x"))
    quartiles = exact_quantiles(known, "x", {"q1": 0.25, "median": 0.5, "q3": 0.75}, by)
    counts = known.groupBy(*by, "x").agg(F.count(F.lit(1)).alias("w"))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = (F.col("x") >= F.col("q1") - reach) & (F.col("x") <= F.col("q3") + reach)
    placed = attach_salted(counts, quartiles, by, "x")
    return placed.groupBy(*by).agg(
        F.max("q1").alias("q1"),
        F.max("median").alias("median"),
        F.max("q3").alias("q3"),
        F.min(F.when(inside, F.col("x"))).alias("low_whisker"),
        F.max(F.when(inside, F.col("x"))).alias("high_whisker"),
        F.sum(F.when(inside, 0).otherwise(F.col("w"))).cast("bigint").alias("outliers"),
        F.sum("w").cast("bigint").alias("n"),
    )


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Observed and expected counts and standardised residuals of every cell, empty cells included.

    The table of all cells is the result itself: the counted categories of both sides, side by side.
    """
    known = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    seen = known.groupBy(a, b).agg(F.count(F.lit(1)).alias("observed"))
    rows = seen.groupBy(a).agg(F.sum("observed").alias("row_total"))
    columns = seen.groupBy(b).agg(F.sum("observed").alias("col_total"))
    total = seen.agg(F.sum("observed")).scalar()
    table = attach(rows.crossJoin(columns), seen, [a, b]).withColumn("observed", F.coalesce("observed", F.lit(0).cast("bigint")))
    table = table.withColumn("total", total)
    expected = F.col("row_total") * F.col("col_total") / F.col("total").cast("double")
    p_row, p_col = F.col("row_total") / F.col("total"), F.col("col_total") / F.col("total")
    table = table.withColumn("expected", expected)
    scatter = F.sqrt(F.col("expected") * (1 - p_row) * (1 - p_col))
    residual = F.try_divide(F.col("observed") - F.col("expected"), scatter)
    return table.select(a, b, "observed", "expected", residual.alias("std_residual"))


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """Statistic, degrees of freedom and Cramer's V of the independence test: one row.

    A 2x2 table gets the continuity correction in the statistic, and Cramer's V goes without it.
    """
    table = contingency(df, a, b)
    gap = F.abs(F.col("observed") - F.col("expected"))
    totals = table.agg(
        F.sum(gap * gap / F.col("expected")).alias("plain"),
        F.sum(F.pow(gap - F.lit(0.5), F.lit(2.0)) / F.col("expected")).alias("corrected"),
        F.min(gap).alias("least_gap"),
        F.sum("observed").alias("n"),
        F.count_distinct(a).alias("r"),
        F.count_distinct(b).alias("c"),
    )
    small = (F.col("r") == 2) & (F.col("c") == 2) & (F.col("least_gap") >= 0.5)
    exact_small = (F.col("r") == 2) & (F.col("c") == 2) & (F.col("least_gap") < 0.5)
    smaller = F.least(F.col("r"), F.col("c")) - 1
    return totals.select(
        F.when(small, F.col("corrected")).when(exact_small, F.lit(0.0)).otherwise(F.col("plain")).alias("statistic"),
        ((F.col("r") - 1) * (F.col("c") - 1)).alias("df"),
        "n",
        F.sqrt(F.try_divide(F.col("plain"), (F.col("n") * smaller).cast("double"))).alias("cramers_v"),
    )


def cramers_v(df: DataFrame, a: str, b: str) -> DataFrame:
    return chi_square(df, a, b).select("cramers_v")


def welch_t(df: DataFrame, col: str, group: str) -> DataFrame:
    """Two-sample t with unequal variances: t, degrees of freedom and both means.  The groups sort by value.

    Other than two groups are an error.
    """
    known = df.where(F.col(col).isNotNull() & F.col(group).isNotNull())
    stats = known.groupBy(group).agg(
        F.avg(col).alias("mean"), F.var_samp(col).alias("var"), F.count(F.lit(1)).alias("n")
    )
    values = F.struct("mean", "var", "n")
    pair = stats.agg(
        F.min_by(values, group).alias("one"), F.max_by(values, group).alias("two"), F.count(F.lit(1)).alias("groups")
    )
    found = F.concat(F.lit("two groups are needed, found "), F.col("groups").cast("string"))
    pair = pair.withColumn("one", F.when(F.col("groups") == 2, F.col("one")).otherwise(F.raise_error(found)))
    one, two = F.col("one"), F.col("two")
    a, b = one["var"] / one["n"], two["var"] / two["n"]
    return pair.select(
        one["mean"].alias("mean_first"),
        two["mean"].alias("mean_second"),
        F.try_divide(one["mean"] - two["mean"], F.sqrt(a + b)).alias("t"),
        F.try_divide(
            F.pow(a + b, F.lit(2.0)), a * a / (one["n"] - 1) + b * b / (two["n"] - 1)
        ).alias("df"),
    )


# ---- p-values: special functions on result rows, a few per job ----------------------------------------------------


LARGE = 1e5  # from here on, uniform expansions whose error is below 1e-7
_TINY = 1e-300


def _fraction(term, start: float) -> float:
    """A continued fraction (modified Lentz), run until it no longer changes; ``term(i)`` gives its i-th pair."""
    value = start or _TINY
    c, d, i = value, 0.0, 0
    while True:
        i += 1
        a, b = term(i)
        d = 1 / ((b + a * d) or _TINY)
        c = (b + a / c) or _TINY
        value *= c * d
        if abs(c * d - 1) < 1e-15:
            return value


def _gamma_q(a: float, x: float) -> float:
    """Upper regularised incomplete gamma function."""
    if x <= 0:
        return 1.0
    if a > LARGE:  # the first two terms of the uniform expansion in the error function
        apart = x / a - 1
        bend = math.copysign(math.sqrt(max(0.0, 2 * (apart - math.log1p(apart)))), apart)
        near = 1 / apart - 1 / bend if abs(apart) > 1e-4 else -1 / 3 + apart / 12
        return 0.5 * math.erfc(bend * math.sqrt(a / 2)) + math.exp(-a * bend * bend / 2) / math.sqrt(2 * math.pi * a) * near
    lead = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        i = 0
        while term > total * 1e-17:
            i += 1
            term *= x / (a + i)
            total += term
        return 1 - lead * total
    return lead / _fraction(lambda i: (-i * (i - a), x + 2 * i + 1 - a), x + 1 - a)


def _beta_i(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_i(b, a, 1 - x)
    lead = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a

    def term(i: int) -> tuple[float, float]:
        m = i // 2
        if i % 2:
            return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
        return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    return lead / _fraction(term, 1.0)


def _t_tail(t: float, df: float) -> float:
    """Two-sided chance of a t as far from zero."""
    if df > 2 * LARGE:  # the normal deviate of the same chance, to the order of 1 / df
        z = t * (1 - 1 / (4 * df)) / math.sqrt(1 + t * t / (2 * df))
        return math.erfc(abs(z) / math.sqrt(2))
    return _beta_i(df / 2, 0.5, df / (df + t * t))


def _chance(tail, statistic: float, df: float) -> float:
    """``tail(statistic, df)``; NaN where either is missing or there are no degrees of freedom, 0 beyond all bounds."""
    if math.isnan(statistic) or math.isnan(df) or df <= 0:
        return math.nan
    if math.isinf(statistic):
        return 0.0 if statistic > 0 or tail is _t_tail else 1.0
    if math.isinf(df):
        return math.erfc(abs(statistic) / math.sqrt(2)) if tail is _t_tail else 1.0
    return tail(statistic, df)


def _chi_tail(statistic: float, df: float) -> float:
    return _gamma_q(df / 2, statistic / 2)


@F.pandas_udf(T.DoubleType())
def chi_square_p(statistic: pd.Series, df: pd.Series) -> pd.Series:
    """Chance of a larger statistic; NaN for a missing one and for no degrees of freedom."""
    return pd.Series([_chance(_chi_tail, s, d) for s, d in zip(statistic.astype(float), df.astype(float))], dtype=float)


@F.pandas_udf(T.DoubleType())
def t_test_p(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided chance of a t as far from zero; NaN for a missing one and for no degrees of freedom."""
    return pd.Series([_chance(_t_tail, s, d) for s, d in zip(t.astype(float), df.astype(float))], dtype=float)


@F.pandas_udf(T.DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    """Two-sided chance of a standard normal as far from zero."""
    return pd.Series([math.erfc(abs(s) / math.sqrt(2)) for s in z.astype(float)], dtype=float)
