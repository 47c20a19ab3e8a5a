"""Connected components of an edge table, by rounds of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.llm.store import kept


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """Tie the neighbours ``v`` of each ``u`` (only the larger ones, or all) to the smallest of them and ``u``.

    The smallest ones are written first, so both sides of the join are plain shuffles and a node with very many
    neighbours can be split.
    """
    least = kept(pairs.groupBy("u").agg(F.min("v").alias("__m")).select("u", F.least("u", "__m").alias("m")))
    tied = pairs.join(least, "u")
    if larger:
        return tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.where("u > m").select("u", F.col("m").alias("v"))
    return tied.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all ends of ``edges`` (u, v); a component is named by its smallest node.

    Self loops and repeated edges are allowed; an empty table gives none.  The number of rounds grows with the
    logarithm of the longest path.
    """
    now = kept(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = kept(_star(both, larger=True).distinct())
        now = kept(_star(large, larger=False).distinct())
        last, state = state, _state(now)
        if state == last:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
