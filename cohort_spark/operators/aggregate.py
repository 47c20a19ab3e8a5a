"""Per-entity aggregates, lags, autocorrelation, samples."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_spark.operators.quality import entities_in
from cohort_spark.operators.reshape import melt
from cohort_spark.plans.chunks import CHUNK_HOURS, CHUNK_ROWS, chunks, lagged, place_of

# How each measurement is summed up per stay.
MEASUREMENT_AGGREGATES = {
    "Age": "last", "Gender": "last", "Height": "last", "Albumin": "last", "ALP": "last", "ALT": "last",
    "AST": "last", "Bilirubin": "last", "BUN": "last", "Cholesterol": "last", "Creatinine": "last",
    "DiasABP": "mean", "FiO2": "mean", "GCS": "min", "Glucose": "mean", "HCO3": "last", "HCT": "last",
    "HR": "mean", "K": "last", "Lactate": "max", "Mg": "last", "MAP": "mean", "MechVent": "last", "Na": "last",
    "NIDiasABP": "mean", "NIMAP": "mean", "NISysABP": "mean", "PaCO2": "last", "PaO2": "mean", "pH": "last",
    "Platelets": "last", "RespRate": "mean", "SaO2": "mean", "SysABP": "mean", "Temp": "max",
    "TroponinI": "max", "TroponinT": "max", "Urine": "sum", "WBC": "last", "Weight": "last",
    "In-hospital_death": "max",
}


def aggregate_by_rules(
    df: DataFrame, rules: Mapping[str, str], order: Sequence[str], entity: str = "entity_id"
) -> DataFrame:
    """One row per entity; a rule per column: last (non-null), mean, min, max or sum (0 when all null)."""

    def last(c: str) -> Column:
        return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), place_of(order)))

    make = {
        "last": last,
        "mean": lambda c: F.avg(c),
        "min": lambda c: F.min(c),
        "max": lambda c: F.max(c),
        "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
    }
    return df.groupBy(entity).agg(*[make[r](c).alias(c) for c, r in rules.items() if c in df.columns])


def extend_rules(rules: Mapping[str, str], cols: Sequence[str]) -> dict[str, str]:
    """The rules, and ``last`` for every lag column."""
    return {**rules, **{c: "last" for c in cols if re.search(r"_lag\d+$", c)}}


def label_per_entity(df: DataFrame, label: str, entity: str = "entity_id") -> DataFrame:
    return df.groupBy(entity).agg(F.max(label).alias(label))


def lag_features(
    df: DataFrame,
    cols: Sequence[str],
    order: Sequence[str],
    lags: Sequence[int] = (1, 2),
    entity: str = "entity_id",
    chunk_hours: float | None = CHUNK_HOURS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``{c}_lag{k}``: the cell ``k`` rows earlier in the history of the entity, null before its start."""
    cols = [c for c in cols if c in df.columns]
    return lagged(df, [entity], order, cols, list(lags), chunks(chunk_hours, chunk_rows))


def autocorrelations(
    df: DataFrame,
    cols: Sequence[str],
    order: Sequence[str],
    lag: int = 1,
    entity: str = "entity_id",
    chunk_hours: float | None = CHUNK_HOURS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Per variable the mean over entities of the correlation of a series with itself ``lag`` readings earlier.

    All columns go through one long pass.  Entities whose correlation is undefined are left out.
    """
    long = melt(df, [entity, *order], cols).where(F.col("value").isNotNull())
    pairs = lagged(long, [entity, "variable"], order, ["value"], [lag], chunks(chunk_hours, chunk_rows))
    pairs = pairs.withColumnRenamed(f"value_lag{lag}", "__then")
    pairs = pairs.where(F.col("__then").isNotNull())
    spread = F.stddev_pop("value") * F.stddev_pop("__then")
    per_entity = (
        pairs.groupBy(entity, "variable")
        .agg(F.count(F.lit(1)).alias("n"), F.covar_pop("value", "__then").alias("c"), spread.alias("s"))
        .select("variable", F.try_divide(F.col("c"), F.col("s")).alias("r"))
        .where(F.col("r").isNotNull())
    )
    return per_entity.groupBy("variable").agg(F.avg("r").alias("acf"), F.count(F.lit(1)).alias("entities"))


def select_by_threshold(candidates: DataFrame, threshold: float = 0.5, score: str = "acf") -> DataFrame:
    return candidates.where(F.abs(F.col(score)) >= threshold)


def _shuffled(key: str, seed: int) -> list[Column]:
    """A random but reproducible order: hash of seed and key, then the key."""
    return [F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), F.col(key)]


def sample_rows(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """``n`` rows without replacement; the same seed gives the same rows on any cluster."""
    return df.orderBy(*_shuffled(key, seed)).limit(n)


def sample_entities(df: DataFrame, n: int, seed: int, entity: str = "entity_id") -> DataFrame:
    """All rows of ``n`` sampled entities."""
    return entities_in(df, sample_rows(df.select(entity).distinct(), n, seed, entity), entity)


def best_config(metrics: DataFrame, config: Sequence[str], score: str) -> DataFrame:
    """The settings with the highest score (ties: the smallest settings); null scores are passed over."""
    known = metrics.where(F.col(score).isNotNull())
    return known.orderBy(F.desc(score), *config).select(*config, score).limit(1)
