"""Probabilities, bins and number text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def softmax_positive(logits: list[Column]) -> Column:
    """Probability of the positive class from one logit or from a pair (negative, positive)."""
    if len(logits) == 1:
        return sigmoid(logits[0])
    if len(logits) == 2:
        return sigmoid(logits[1] - logits[0])
    raise ValueError(f"one or two logits expected, got {len(logits)}")


def bin_centre(col: Column, width: float) -> Column:
    """Centre of the bin of ``width`` that holds the value: centres are multiples of the width, bins close right."""
    w = F.lit(float(width))
    return F.ceil((col - w / 2) / w).cast("double") * w


def two_decimals(col: Column) -> Column:
    """``%.2f`` text, rounded half up through a decimal; numbers too large for one have no digits to round."""
    return F.coalesce(col.try_cast("decimal(28,2)").cast("string"), F.format_string("%.2f", col.cast("double")))


def nudge(digits: int) -> float:
    """A shift far below the last digit kept."""
    return 10.0 ** -(digits + 2) / 3


def half_up(col: Column, digits: int = 6) -> Column:
    """Rounded for comparison across engines: exact ties, which engines break differently, are nudged upwards
    first, and negative zero is removed."""
    return F.round(col + F.lit(nudge(digits)), digits) + F.lit(0.0)
