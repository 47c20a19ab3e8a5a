"""Running totals along a value, the base of exact ranks, quantiles and ranking metrics.

Rows are first counted per (group, distinct value), which collapses hot values before they travel.  The
distinct values are then cut into chunks of about ``CHUNK_VALUES`` counted rows at approximate quantiles of the whole column,
which a mergeable sketch over the counted rows gives.  The sketch is a scalar subquery of the same plan: no job runs
before the result is asked for, and the counted rows are made once for the sketch and for the totals.
The cuts only balance the work: each (group, chunk) is a share of all rows, however large one group is, and the totals stay
exact whatever the cuts are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohort_spark.plans.chunks import CHUNK, attach, with_parameters

GRID = 1024  # a power of two: the finest share of all values that a chunk can be
ACCURACY = 4 * GRID
CHUNK_VALUES = 1 << 18


def with_value_chunks(counted: DataFrame, value: str, weights: Sequence[str], size: int = CHUNK_VALUES) -> DataFrame:
    """Add ``CHUNK``: the share of the values that a row's value falls into, growing with the value.

    There are as many shares as ``size`` goes into the number of rows, and ``GRID`` at most.
    """
    x = F.col(value).cast("double")
    # one literal instead of a column per share
    shares = F.percentile_approx(x, F.split(F.lit(",".join(str(i / GRID) for i in range(1, GRID))), ",").cast("array<double>"), ACCURACY)
    # the weights are named so that the sketch and the totals read the same counted rows
    fit = counted.agg(F.count(F.lit(1)).alias("rows"), shares.alias("cuts"), *[F.max(w).alias(f"most_{w}") for w in weights])
    fit = fit.select(F.least(F.ceil(F.col("rows") / size), F.lit(GRID)).alias("chunks"), "cuts")
    steps = F.array(*[F.lit(GRID >> k) for k in range(1, GRID.bit_length())])

    def passed(cuts: Column) -> Column:
        """How many cuts are no larger than the value, by halving."""
        return F.aggregate(steps, F.lit(0), lambda at, step: F.when(x >= F.element_at(cuts, at + step), at + step).otherwise(at))

    cut = F.col("__cuts")
    chunk = F.when(cut["chunks"] > 1, F.floor(passed(cut["cuts"]) * cut["chunks"] / GRID)).otherwise(0)
    return with_parameters(counted, fit, "__cuts").select(*counted.columns, chunk.alias(CHUNK))


def value_runs(
    df: DataFrame,
    value: str,
    weights: Mapping[str, Column],
    by: Sequence[str] = (),
    size: int = CHUNK_VALUES,
) -> DataFrame:
    """One row per (group, distinct non-null value) with totals.

    For each weight ``w`` the columns are ``w`` (total at the value), ``w_before`` (total at smaller values
    of the group) and ``w_all`` (total of the group).
    """
    by, names = list(by), list(weights)
    known = df.where(F.col(value).isNotNull())
    if dict(df.dtypes)[value] in ("float", "double"):
        known = known.where(~F.isnan(value))  # NaN is no value
    counted = known.groupBy(*by, value).agg(*[F.sum(col).alias(w) for w, col in weights.items()])
    counted = with_value_chunks(counted, value, names, size)
    totals = counted.groupBy(*by, CHUNK).agg(*[F.sum(w).alias(w) for w in names])
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    earlier = group.orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        CHUNK,
        *[F.coalesce(F.sum(w).over(earlier), F.lit(0)).alias(f"__{w}_offset") for w in names],
        *[F.sum(w).over(group).alias(f"{w}_all") for w in names],
    )
    smaller = W.partitionBy(*by, CHUNK).orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    inside = {f"{w}_before": F.coalesce(F.sum(w).over(smaller), F.lit(0)) for w in names}
    joined = attach(counted.withColumns(inside), offsets, [*by, CHUNK], null_safe=bool(by))
    return joined.select(
        *by,
        value,
        *names,
        *[(F.col(f"{w}_before") + F.col(f"__{w}_offset")).alias(f"{w}_before") for w in names],
        *[f"{w}_all" for w in names],
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    size: int = CHUNK_VALUES,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group and one column per entry of ``probs``.

    The built-in ``percentile`` keeps all distinct values of a group in the memory of one task; this
    does not, so it holds for whole columns.  Nulls are left out.
    """
    runs = value_runs(df, value, {"__n": F.lit(1).cast("bigint")}, by, size)
    before, upto, n = F.col("__n_before"), F.col("__n_before") + F.col("__n"), F.col("__n_all")

    def value_at(rank: Column) -> Column:
        return F.max(F.when((before <= rank) & (rank < upto), F.col(value).cast("double")))

    picks = []
    for name, p in probs.items():
        place = (n - 1) * F.lit(float(p))
        picks += [
            value_at(F.floor(place)).alias(f"__{name}_lo"),
            value_at(F.ceil(place)).alias(f"__{name}_hi"),
            F.max(place - F.floor(place)).alias(f"__{name}_part"),
        ]
    found = runs.groupBy(*by).agg(*picks)
    return found.select(
        *by,
        *[
            (F.col(f"__{q}_lo") + (F.col(f"__{q}_hi") - F.col(f"__{q}_lo")) * F.col(f"__{q}_part")).alias(q)
            for q in probs
        ],
    )
