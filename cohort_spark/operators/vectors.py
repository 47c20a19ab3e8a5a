"""Embeddings as table operators: making, pooling, joining, reshaping."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_spark.operators.relate import attach_labels
from cohort_spark.operators.reshape import melt
from cohort_spark.plans.chunks import CHUNK_HOURS, CHUNK_ROWS, chunks, number_rows


def _columns(df: DataFrame, keys: Sequence[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema)


def embed_text(
    df: DataFrame,
    text: str,
    make_client: Callable[[], Callable[[Sequence[str]], np.ndarray]],
    keys: Sequence[str] = ("entity_id",),
    out: str = "embedding",
) -> DataFrame:
    """A vector per row from a pluggable encoder, called on Arrow batches and built once per partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for batch in batches:
            vectors = client(batch[text].tolist())
            yield batch[list(keys)].assign(**{out: list(np.asarray(vectors, dtype=np.float32))})

    return df.select(*keys, text).mapInPandas(run, f"{_columns(df, keys)}, `{out}` array<float>")


def batches_by_length(lengths: Sequence[int], places: int) -> Iterator[list[int]]:
    """Numbers of pieces in order of length, in batches whose padded size is ``places`` at most (or one piece)."""
    batch: list[int] = []
    for i in sorted(range(len(lengths)), key=lengths.__getitem__):
        if batch and (len(batch) + 1) * lengths[i] > places:
            yield batch
            batch = []
        batch.append(i)
    if batch:
        yield batch


def embed_series(
    df: DataFrame,
    cols: Sequence[str],
    make_client: Callable[[], Callable[[np.ndarray, np.ndarray], np.ndarray]],
    context: int = 8192,
    batch_tokens: int = 1 << 16,
    entity: str = "entity_id",
    ts: str = "ts",
    chunk_hours: float | None = CHUNK_HOURS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Token vectors of the non-null series of every entity and variable.

    A series longer than the ``context`` of the encoder is embedded in consecutive pieces, numbered by
    ``piece``; nothing is cut off, and no row holds more than ``context`` readings.

    The client gets batches: pieces of similar length, padded at their ends to the longest, with a mask of what is real.
    A batch holds ``batch_tokens`` places at most, or one piece.
    """
    long = melt(df, [entity, ts], cols).where(F.col("value").isNotNull())
    numbered = number_rows(long, [entity, "variable"], [ts], "__at", chunks(chunk_hours, chunk_rows))
    piece = F.floor((F.col("__at") - 1) / context).alias("piece")
    series = numbered.groupBy(entity, "variable", piece).agg(
        F.array_sort(F.collect_list(F.struct("__at", "value"))).alias("steps")
    )
    series = series.select(entity, "variable", "piece", F.transform("steps", lambda s: s["value"]).alias("series"))
    keys = [entity, "variable", "piece"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for batch in batches:
            series = [np.asarray(s, dtype=float) for s in batch["series"]]
            tokens: list = [None] * len(series)
            for members in batches_by_length([len(s) for s in series], batch_tokens):
                longest = max(len(series[i]) for i in members)
                padded, mask = np.zeros((len(members), longest)), np.zeros((len(members), longest), dtype=bool)
                for row, i in enumerate(members):
                    padded[row, : len(series[i])], mask[row, : len(series[i])] = series[i], True
                made = np.asarray(client(padded, mask), dtype=np.float32)
                for row, i in enumerate(members):
                    tokens[i] = made[row, : len(series[i])].tolist()
            yield batch[keys].assign(tokens=tokens)

    return series.mapInPandas(run, f"{_columns(series, keys)}, tokens array<array<float>>")


def mean_pool(df: DataFrame, by: Sequence[str], vector: str = "embedding", out: str | None = None) -> DataFrame:
    """Element-wise mean of the vectors of each group, by an aggregate that combines on the map side."""
    pooled = Summarizer.mean(array_to_vector(F.col(vector)))
    grouped = df.where(F.col(vector).isNotNull()).groupBy(*by).agg(pooled.alias("__mean"))
    return grouped.select(*by, vector_to_array("__mean").alias(out or vector))


def pool_tokens(df: DataFrame, by: Sequence[str], tokens: str = "tokens", out: str = "embedding") -> DataFrame:
    """Mean over all tokens of a group."""
    return mean_pool(df.select(*by, F.explode(tokens).alias(out)), by, out)


def patient_embedding(
    df: DataFrame,
    cols: Sequence[str],
    make_client: Callable[[], Callable[[np.ndarray, np.ndarray], np.ndarray]],
    width: int | None = None,
    entity: str = "entity_id",
    **options,
) -> DataFrame:
    """Mean over variables of the mean over tokens.

    Entities without any reading are left out, or get the zero vector if its ``width`` is given.
    """
    per_variable = pool_tokens(embed_series(df, cols, make_client, entity=entity, **options), [entity, "variable"])
    pooled = mean_pool(per_variable, [entity])
    if width is None:
        return pooled
    every = df.select(entity).distinct().join(pooled, entity, "left")
    return every.withColumn("embedding", F.coalesce("embedding", F.array_repeat(F.lit(0.0), width)))


def concat_channels(
    df: DataFrame, variables: Sequence[str], width: int, entity: str = "entity_id", vector: str = "embedding"
) -> DataFrame:
    """One vector per entity: its vectors by variable in a fixed order, zeros where a variable is missing."""

    def channel(name: str) -> Column:
        return F.any_value(F.when(F.col("variable") == name, F.col(vector)), F.lit(True)).alias(f"__{name}")

    zeros = F.array_repeat(F.lit(0.0), width).cast(dict(df.dtypes)[vector])
    wide = df.groupBy(entity).agg(*[channel(v) for v in variables])
    return wide.select(entity, F.concat(*[F.coalesce(f"__{v}", zeros) for v in variables]).alias(vector))


def labelled_embeddings(df: DataFrame, labels: DataFrame, entity: str = "entity_id") -> DataFrame:
    """Vectors with their labels, related by key; rows without a label are left out."""
    return attach_labels(df, labels, "inner", entity)


def embeddings_to_wide(df: DataFrame, width: int, keep: Sequence[str], vector: str = "embedding") -> DataFrame:
    """One column per dimension, named by its number."""
    return df.select(*keep, *[F.col(vector)[i].alias(str(i)) for i in range(width)])


def embeddings_from_wide(df: DataFrame, keep: Sequence[str], vector: str = "embedding") -> DataFrame:
    """The vector of all number-named columns, in numeric order."""
    dims = sorted((c for c in df.columns if c.isdigit()), key=int)
    return df.select(*keep, F.array(*[F.col(c).cast("float") for c in dims]).alias(vector))


def extract_embeddings(
    sequences: DataFrame, encoder, vector: str = "sequence", keep: Sequence[str] = ("entity_id", "label")
) -> DataFrame:
    """Codes of flattened sequences from a fitted encoder (a model with ``transform`` from features to code)."""
    flat = sequences.select(*keep, array_to_vector(F.flatten(vector)).alias("features"))
    return encoder.transform(flat).select(*keep, vector_to_array("code").alias("embedding"))
