"""Per-entity series features and their selection against a binary target."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_spark.operators.explore import normal_p
from cohort_spark.operators.reshape import melt
from cohort_spark.plans.chunks import attach
from cohort_spark.plans.runs import exact_quantiles, value_runs

# Names of the features of a series.
MINIMAL_FEATURES = [
    "sum_values", "median", "mean", "length", "standard_deviation", "variance", "root_mean_square", "maximum",
    "absolute_maximum", "minimum",
]


def extract_minimal_features(
    df: DataFrame, cols: Sequence[str], entity: str = "entity_id", bounded: bool = False
) -> DataFrame:
    """``{column}__{feature}`` per entity over its non-null readings.

    All but the median are plain aggregates.  The median is exact; it takes the built-in percentile where the
    rows per entity are ``bounded`` (an hourly panel), and value counts, which no hot entity can overload,
    where they are not.
    """
    cells = df.select(entity, *[F.col(c).cast("double").alias(c) for c in cols])

    def features(c: str) -> dict[str, Column]:
        out = {
            "sum_values": F.coalesce(F.sum(c), F.lit(0.0)),
            "mean": F.avg(c),
            "length": F.count(c).cast("double"),
            "standard_deviation": F.stddev_pop(c),
            "variance": F.var_pop(c),
            "root_mean_square": F.sqrt(F.avg(F.col(c) * F.col(c))),
            "maximum": F.max(c),
            "absolute_maximum": F.max(F.abs(c)),
            "minimum": F.min(c),
        }
        return out | ({"median": F.percentile(c, F.lit(0.5))} if bounded else {})

    stats = cells.groupBy(entity).agg(*[x.alias(f"{c}__{f}") for c in cols for f, x in features(c).items()])
    if not bounded:
        long = melt(cells, [entity], cols)
        medians = exact_quantiles(long, "value", {"median": 0.5}, [entity, "variable"])
        wide = medians.groupBy(entity).agg(
            *[F.max(F.when(F.col("variable") == c, F.col("median"))).alias(f"{c}__median") for c in cols]
        )
        stats = attach(stats, wide, [entity])
    return stats.select(entity, *[f"{c}__{f}" for c in cols for f in MINIMAL_FEATURES])


def rank_sums(long: DataFrame, feature: str = "feature", value: str = "value", label: str = "label") -> DataFrame:
    """Mann-Whitney statistics of every feature against a 0/1 label: one row per feature.

    Average ranks come from running totals over distinct values, so no feature is ranked in one task.
    ``z`` is the tie-corrected normal score with continuity correction; null for a constant feature.
    ``low_pos`` and ``low_neg`` count the labels at the smallest value.
    """
    weights = {
        "pos": (F.col(label) == 1).cast("bigint"),
        "neg": (F.col(label) == 0).cast("bigint"),
        "n": F.lit(1).cast("bigint"),
    }
    runs = value_runs(long.where(F.col(label).isNotNull()), value, weights, [feature])
    wins = F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0)
    t = F.col("n").cast("double")
    sums = runs.groupBy(feature).agg(
        F.sum(wins).alias("u"),
        F.sum(t * t * t - t).alias("ties"),
        F.count(F.lit(1)).alias("distinct_values"),
        F.max("pos_all").alias("positives"),
        F.max("neg_all").alias("negatives"),
        F.max("n_all").alias("n"),
        F.max(F.when(F.col("n_before") == 0, F.col("pos"))).alias("low_pos"),
        F.max(F.when(F.col("n_before") == 0, F.col("neg"))).alias("low_neg"),
    )
    n, p, q = F.col("n").cast("double"), F.col("positives").cast("double"), F.col("negatives").cast("double")
    spread = F.sqrt(F.greatest(p * q / 12.0 * (n + 1.0 - F.try_divide(F.col("ties"), n * (n - 1.0))), F.lit(0.0)))
    away = F.col("u") - p * q / 2.0
    z = F.try_divide(F.signum(away) * F.greatest(F.abs(away) - 0.5, F.lit(0.0)), spread)
    return sums.select(
        feature, "u", z.alias("z"), "distinct_values", "positives", "negatives", "n", "low_pos", "low_neg"
    )


def two_by_two(long: DataFrame, feature: str = "feature", value: str = "value", label: str = "label") -> DataFrame:
    """Counts of the larger and smaller value by label, for features with exactly two values."""
    known = long.where(F.col(label).isNotNull() & F.col(value).isNotNull())
    counts = known.groupBy(feature, value).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    ends = counts.groupBy(feature).agg(
        F.count(F.lit(1)).alias("k"),
        F.max_by(F.struct("pos", "neg"), value).alias("high"),
        F.min_by(F.struct("pos", "neg"), value).alias("low"),
    )
    return ends.where("k = 2").select(
        feature,
        F.col("high.pos").alias("high_pos"),
        F.col("high.neg").alias("high_neg"),
        F.col("low.pos").alias("low_pos"),
        F.col("low.neg").alias("low_neg"),
    )


@F.pandas_udf(T.DoubleType())
def fisher_p(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    """Two-sided Fisher exact test of a 2x2 table: the chance of all tables that are no more likely."""

    def one(a: int, b: int, c: int, d: int) -> float:
        rows, cols, n = a + b, a + c, a + b + c + d
        if n == 0:
            return 1.0
        middle = rows * cols / n
        sd = math.sqrt(middle * (n - rows) / n * (n - cols) / max(n - 1, 1))
        # the mass outside forty deviations is below double precision
        first = max(0, rows + cols - n, math.floor(middle - 40 * sd) - 50)
        last = min(rows, cols, math.ceil(middle + 40 * sd) + 50)
        if not first <= a <= last:
            return 0.0
        x = np.arange(first, last, dtype=float)
        steps = np.log(rows - x) + np.log(cols - x) - np.log(x + 1) - np.log(n - rows - cols + x + 1)
        chance = np.concatenate([[0.0], np.cumsum(steps)])
        chance -= chance.max()
        seen = chance[a - first]
        weight = np.exp(chance)
        return float(min(1.0, weight[chance <= seen + 1e-7].sum() / weight.sum()))

    return pd.Series([one(*map(int, row)) for row in zip(a, b, c, d)])


def feature_relevance(
    features: DataFrame, labels: DataFrame, cols: Sequence[str], entity: str = "entity_id", label: str = "label"
) -> DataFrame:
    """P-value of every feature against a binary label: Fisher for two-valued, Mann-Whitney for other features.

    Constant features are left out.
    """
    joined = attach(features, labels.select(entity, label), [entity], "inner")
    stats = rank_sums(melt(joined, [entity, label], cols, "feature", "value"), label=label)
    binary = F.col("distinct_values") == 2
    low_pos, low_neg = F.coalesce("low_pos", F.lit(0)), F.coalesce("low_neg", F.lit(0))
    fisher = fisher_p(F.col("positives") - low_pos, F.col("negatives") - low_neg, low_pos, low_neg)
    return stats.where("distinct_values > 1").select(
        "feature",
        F.when(binary, "binary").otherwise("real").alias("kind"),
        F.when(binary, fisher).otherwise(normal_p(F.coalesce("z", F.lit(0.0)))).alias("p"),
    )


def select_relevant(p_values: DataFrame, fdr: float = 0.05, feature: str = "feature", p: str = "p") -> DataFrame:
    """Benjamini-Yekutieli step-up: the features up to the largest rank whose p-value passes its bound.

    There is one row per feature, so the ranking runs over as many rows as the frame had columns.
    """
    all_rows = W.partitionBy(F.lit(0))
    ordered = all_rows.orderBy(p, feature)
    ranked = p_values.where(F.col(p).isNotNull()).select(
        feature, p, F.row_number().over(ordered).alias("rank"), F.count(F.lit(1)).over(all_rows).alias("m")
    )
    ranked = ranked.withColumn("harmonic", F.sum(1.0 / F.col("rank")).over(all_rows))
    bound = F.col("rank") * F.lit(fdr) / (F.col("m") * F.col("harmonic"))
    passing = ranked.withColumn("last", F.max(F.when(F.col(p) <= bound, F.col("rank"))).over(all_rows))
    return passing.where("rank <= last").select(feature, p, "rank")


def align_features(df: DataFrame, names: Sequence[str], keys: Sequence[str] = ("entity_id",)) -> DataFrame:
    """The selected columns; one the frame lacks becomes null."""
    have = set(df.columns)
    return df.select(*keys, *[F.col(c) if c in have else F.lit(None).cast("double").alias(c) for c in names])
