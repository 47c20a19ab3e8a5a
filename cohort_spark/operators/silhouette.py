"""Silhouette: how close rows lie to their own cluster against the nearest other one."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 4_000


def silhouette(df: DataFrame, vector: str = "embedding", label: str = "label", key: str = "vec_id") -> DataFrame:
    """Mean of (b - a) / max(a, b) over all rows, with Euclidean distances: one row.

    Mean distances to a cluster have no shorter form than the sum over its members, so the work is quadratic.
    It is cut into tiles of bounded size: rows are hashed into ``b`` blocks of about ``BLOCK_ROWS``, and every two blocks meet
    once, in one of ``b * (b + 1) / 2`` tiles.  A tile computes each distance once and hands on one sum per row and cluster for
    both of its blocks, never a pair; ``b`` copies of every row are shuffled.  For data where
    that is too much, ``silhouette_squared`` is linear.
    """
    points = df.where(F.col(label).isNotNull()).select(
        F.col(key).alias("id"), F.col(label).alias("cluster"), F.col(vector).cast("array<double>").alias("x")
    )
    blocks = max(1, -(-points.count() // BLOCK_ROWS))
    placed = points.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    met = met.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other")
    types = dict(points.dtypes)
    columns = ["id", "cluster", "other", "total", "n"]

    def sums_to(rows: pd.DataFrame, others: pd.DataFrame, distance: np.ndarray) -> list[pd.DataFrame]:
        """The sum of every row's distances to the members of each cluster among ``others``."""
        out = []
        for cluster, members in others.groupby("cluster").indices.items():
            total = distance[:, members].sum(axis=1)
            out.append(pd.DataFrame({"id": rows["id"], "cluster": rows["cluster"], "other": cluster, "total": total, "n": len(members)}))
        return out

    def tile(key: tuple, both: pd.DataFrame) -> pd.DataFrame:
        a, b = (both[both["block"] == k] for k in key)
        out = []
        if len(a) and len(b):
            x, y = np.stack(a["x"].to_list()), np.stack(b["x"].to_list())
            gram = (x**2).sum(1)[:, None] + (y**2).sum(1)[None, :] - 2 * x @ y.T
            gram[a["id"].to_numpy()[:, None] == b["id"].to_numpy()[None, :]] = 0.0
            distance = np.sqrt(np.maximum(gram, 0.0))
            out = sums_to(a, b, distance) + (sums_to(b, a, distance.T) if key[0] != key[1] else [])
        return pd.concat(out) if out else pd.DataFrame(columns=columns)

    schema = f"id {types['id']}, cluster {types['cluster']}, other {types['cluster']}, total double, n bigint"
    sums = met.groupBy("i", "j").applyInPandas(tile, schema)
    sums = sums.groupBy("id", "cluster", "other").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    own = F.col("cluster") == F.col("other")
    each = sums.groupBy("id").agg(
        F.max(F.when(own, F.try_divide(F.col("total"), F.col("n") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"),
    )
    width = F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b"))
    return each.agg(F.avg(F.when(F.col("a").isNull(), 0.0).otherwise(F.coalesce(width, F.lit(0.0)))).alias("silhouette"))


def silhouette_squared(
    df: DataFrame, vector: str = "embedding", label: str = "label", key: str = "vec_id"
) -> DataFrame:
    """The same with squared Euclidean distances, in linear time.

    The mean squared distance to a cluster follows from its size, its mean vector and its mean squared norm.
    """
    points = df.where(F.col(label).isNotNull()).select(
        F.col(key).alias("id"), F.col(label).alias("cluster"), F.col(vector).cast("array<double>").alias("x")
    )
    norm = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    parts = points.select("cluster", F.posexplode("x").alias("pos", "v"))
    means = parts.groupBy("cluster", "pos").agg(F.avg("v").alias("v"))
    centres = means.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("c"))
    sizes = points.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg(norm).alias("norm"))
    table = centres.join(sizes, "cluster").select("cluster", F.transform("c", lambda e: e["v"]).alias("c"), "n", "norm")
    clusters = table.agg(F.collect_list(F.struct("*")).alias("all")).scalar()
    rows = points.withColumn("sq", norm).withColumn("all", clusters)

    def mean_to(cluster):
        dot = F.aggregate(F.zip_with("x", cluster["c"], lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
        return F.greatest(F.col("sq") + cluster["norm"] - 2 * dot, F.lit(0.0))

    own = F.try_element_at(F.filter("all", lambda c: c["cluster"] == F.col("cluster")), F.lit(1))
    others = F.filter("all", lambda c: c["cluster"] != F.col("cluster"))
    a = F.try_divide(mean_to(own) * own["n"], own["n"] - 1)
    rows = rows.select(own["n"].alias("size"), a.alias("a"), F.array_min(F.transform(others, mean_to)).alias("b"))
    width = F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b"))
    return rows.agg(F.avg(F.when(F.col("size") == 1, 0.0).otherwise(F.coalesce(width, F.lit(0.0)))).alias("silhouette"))
