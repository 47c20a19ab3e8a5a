"""Cell rules: column in, cleaned column out.  All are plain expressions, so a whole rule list is one projection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_if_equals(col: Column, value) -> Column:
    return F.nullif(col, F.lit(value))


def null_out_of_range(col: Column, low: float, high: float) -> Column:
    """Keep ``low <= x < high``."""
    return F.when((col >= low) & (col < high), col)


def null_below(col: Column, threshold: float) -> Column:
    return F.when(col >= threshold, col)


def recode_value(col: Column, old, new) -> Column:
    return F.when(col == old, F.lit(new)).otherwise(col)


def unit_correction(col: Column, ranges: Sequence[tuple[float, float, float]]) -> Column:
    """Divide by the factor of the first inclusive range that holds the value."""
    out = col
    for low, high, factor in reversed(list(ranges)):
        out = F.when(col.between(low, high), col / F.lit(float(factor))).otherwise(out)
    return out


RULES = {
    "null_if_equals": null_if_equals,
    "null_out_of_range": null_out_of_range,
    "null_below": null_below,
    "recode_value": recode_value,
    "unit_correction": unit_correction,
}


def apply_rules(col: Column, rules: Sequence[tuple]) -> Column:
    """Rules in order, each ``(name, *arguments)``."""
    return reduce(lambda acc, rule: RULES[rule[0]](acc, *rule[1:]), rules, col)


# The cleaning rules for bedside measurements (units: cm, kg, mmHg, pH, Celsius).
MEASUREMENT_RULES: dict[str, list[tuple]] = {
    "Age": [("null_if_equals", -1)],
    "Gender": [("null_if_equals", -1)],
    "ICUType": [("null_if_equals", -1)],
    "Height": [("null_if_equals", -1), ("null_out_of_range", 100, 300)],
    "Weight": [("null_if_equals", -1), ("null_out_of_range", 20, 300)],
    "PaO2": [("null_if_equals", 0), ("recode_value", 7.47, 74.7)],
    "pH": [("unit_correction", [(65, 80, 10), (650, 800, 100)])],
    "Temp": [("null_below", 20)],
}
