"""Panels as tokens and as padded sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_spark.functions.time import normalize_time
from cohort_spark.operators.reshape import feature_index, index_features, melt
from cohort_spark.operators.scale import minmax_scale
from cohort_spark.plans.chunks import CHUNK_HOURS, CHUNK_ROWS, attach, chunks, number_rows

#: Steps of a row where none are asked for; a longer history goes on in further rows.
MOST_STEPS = 100_000


def build_tzv(
    df: DataFrame,
    labels: DataFrame,
    features: Sequence[str],
    base_time: str,
    duration_hours: float = 48,
    fit_on: DataFrame | None = None,
    entity: str = "entity_id",
    ts: str = "ts",
    label: str = "label",
    sort: bool = True,
) -> tuple[DataFrame, dict[str, int]]:
    """Triples of normalised time T, variable index Z and scaled value V, with entity and label, and the index.

    Values are scaled onto [0, 1] by the frame itself or by ``fit_on``.  ``sort`` orders the result by T, which
    is a range partitioning; it can be left out where order does not matter.
    """
    scaled = minmax_scale(df, fit_on if fit_on is not None else df, features)
    timed = attach(scaled, labels.select(entity, label), [entity]).withColumn(
        "T", normalize_time(F.col(ts), base_time, duration_hours)
    )
    long = melt(timed, [entity, "T", label], features, "variable", "V").where(F.col("V").isNotNull())
    triples = index_features(long, features, "variable", "Z").select(entity, "T", "Z", "V", label)
    return (triples.orderBy("T", entity, "Z") if sort else triples), feature_index(features)


def build_sequences(
    df: DataFrame,
    features: Sequence[str],
    labels: DataFrame | None = None,
    pad_to: int | None = None,
    entity: str = "entity_id",
    ts: str = "ts",
    chunk_hours: float | None = CHUNK_HOURS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The steps of each entity in time order as a float matrix, padded with zero rows at the end.

    ``pad_to`` is the number of steps per row.  A history that is longer goes on in further rows, numbered by
    ``segment``, so a row never outgrows a fixed size and no step is lost.  Without ``pad_to`` the longest
    history sets it, one row per entity; histories beyond ``MOST_STEPS`` then raise an error, as
    padding every entity to such a length can't be meant.
    """
    zero = F.array(*[F.lit(0.0).cast("float") for _ in features])
    step = F.array(*[F.coalesce(F.col(c).cast("float"), F.lit(0.0).cast("float")) for c in features])
    if pad_to is None:
        longest = df.groupBy(entity).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        pad_to = min(longest or 1, MOST_STEPS)
    numbered = number_rows(df.select(entity, ts, step.alias("step")), [entity], [ts], "__at", chunks(chunk_hours, chunk_rows))
    segment = F.floor((F.col("__at") - 1) / pad_to).alias("segment")
    rows = numbered.select(entity, ts, segment, "step")
    groups = rows.groupBy(entity, "segment").agg(F.array_sort(F.collect_list(F.struct(ts, "step"))).alias("steps"))
    groups = groups.select(
        entity, "segment", F.size("steps").alias("length"), F.transform("steps", lambda s: s["step"]).alias("sequence")
    )
    padded = groups.withColumn("__to", F.lit(pad_to))
    filler = F.array_repeat(zero, F.col("__to") - F.col("length"))
    out = padded.select(entity, "segment", "length", F.concat("sequence", filler).alias("sequence"))
    return out if labels is None else attach(out, labels, [entity], "inner")


def sequence_sums(sequences: DataFrame, width: int, keep: Sequence[str] = ("entity_id", "segment", "length")) -> DataFrame:
    """Padded length and the sum of every feature over the steps: a check of sequences."""

    def total(i: int) -> Column:
        return F.aggregate("sequence", F.lit(0.0), lambda s, row: s + row[i].cast("double")).alias(f"sum{i}")

    return sequences.select(*keep, F.size("sequence").alias("padded"), *[total(i) for i in range(width)])
