"""Ranking and probability metrics, all from sums over distinct scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_spark.plans.runs import value_runs


def _runs(df: DataFrame, score: str, label: str, by: Sequence[str]) -> DataFrame:
    weights = {
        "pos": (F.col(label) == 1).cast("bigint"),
        "n": F.lit(1).cast("bigint"),
    }
    return value_runs(df.where(F.col(label).isNotNull()), score, weights, by)


def _auroc() -> Column:
    neg_all = F.max("n_all") - F.max("pos_all")
    neg = F.col("n") - F.col("pos")
    neg_before = F.col("n_before") - F.col("pos_before")
    wins = F.sum(F.col("pos") * (neg_before + neg / 2.0))
    return F.try_divide(wins, (F.max("pos_all") * neg_all).cast("double"))


def _average_precision() -> Column:
    """Precision at each distinct score, weighted with the recall it adds; null for one class, as the AUROC is."""
    found = (F.col("pos_all") - F.col("pos_before")).cast("double")
    taken = F.col("n_all") - F.col("n_before")
    area = F.try_divide(F.sum(F.col("pos") * found / taken), F.max("pos_all").cast("double"))
    return F.when(F.max("n_all") > F.max("pos_all"), area)


def auroc(df: DataFrame, score: str = "score", label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve with ties counted half.  Null for a group of one class."""
    return _runs(df, score, label, by).groupBy(*by).agg(_auroc().alias("auroc"))


def average_precision(df: DataFrame, score: str = "score", label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """Step-wise average precision.  Null for a group of one class."""
    return _runs(df, score, label, by).groupBy(*by).agg(_average_precision().alias("average_precision"))


def accuracy(df: DataFrame, predicted: str, label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg((F.col(predicted) == F.col(label)).cast("double")).alias("accuracy"))


def logit_loss(logit: Column, y: Column) -> Column:
    """Cross entropy of one row from its logit, in the form that does not overflow."""
    return F.greatest(logit, F.lit(0.0)) - logit * y + F.log1p(F.exp(-F.abs(logit)))


def probability_loss(prob: Column, y: Column, eps: float = 2.220446049250313e-16) -> Column:
    """Cross entropy of one row from its probability, kept off 0 and 1."""
    p = F.least(F.greatest(prob, F.lit(eps)), F.lit(1 - eps))
    return -(y * F.ln(p) + (1 - y) * F.ln(1 - p))


def log_loss(
    df: DataFrame, score: str, label: str = "label", from_logit: bool = False, by: Sequence[str] = ()
) -> DataFrame:
    loss = logit_loss if from_logit else probability_loss
    y = F.col(label).cast("double")
    return df.groupBy(*by).agg(F.avg(loss(F.col(score).cast("double"), y)).alias("log_loss"))


def evaluate(
    df: DataFrame, score: str = "score", label: str = "label", by: Sequence[str] = (), from_logit: bool = False
) -> DataFrame:
    """Rows, log loss, AUROC and average precision per group: one metrics table."""
    loss = logit_loss if from_logit else probability_loss
    x, pos, neg = F.col(score).cast("double"), F.col("pos"), F.col("n") - F.col("pos")
    # rows with equal scores and labels share their loss
    total = F.when(pos > 0, pos * loss(x, F.lit(1.0))).otherwise(0.0) + F.when(neg > 0, neg * loss(x, F.lit(0.0))).otherwise(0.0)
    return _runs(df, score, label, by).groupBy(*by).agg(
        F.max("n_all").alias("n"),
        (F.sum(total) / F.max("n_all")).alias("log_loss"),
        _auroc().alias("auroc"),
        _average_precision().alias("average_precision"),
    )
