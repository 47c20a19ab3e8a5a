"""Shuffling of records into shards in two passes.

Pass 1 scatters records: seeded hashes of the key choose a shard, and within the shard one of as many buckets as it
takes for a bucket to fit into memory.  Pass 2 gathers each bucket and shuffles it (Fisher-Yates, Spark's ``shuffle``);
buckets of a shard follow one another, so a record's slot is its place in its bucket plus the sizes of the buckets before.

Shards are chosen by rendezvous: the shard whose hash with the key is largest.  Only the key and the number of shards
decide, and one more shard takes records only into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SEED = 20240229
BUCKET_BYTES = 4 << 20
_LOW = 16  # bits of a rendezvous value that hold the shard's number
FIXED = 8


def _bid(key: str, shard: int, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(shard), F.col(key)).bitwiseAND(F.lit(-1 << _LOW)).bitwiseOR(F.lit(shard))


def shard_of(key: str, shards: int, seed: int = SEED) -> Column:
    """The shard of a key; a null key is a key of its own."""
    if not 1 <= shards <= 1 << _LOW:
        raise ValueError(f"the number of shards must lie between 1 and {1 << _LOW}")
    bids = [_bid(key, s, seed) for s in range(shards)]
    return (F.greatest(*bids) if shards > 1 else bids[0]).bitwiseAND(F.lit((1 << _LOW) - 1)).cast("int")


def record_bytes(text: str) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(FIXED)).cast("bigint")


def shuffle_into_shards(
    records: DataFrame, shards: int, key: str = "doc_id", text: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """(record, shard, slot): each row of ``records`` as a struct, with its shard and its place there, gapless from 0.

    Buckets are chosen by a hash of key and text, so one key with many texts is spread over its shard's buckets; only rows
    that repeat in both share one.  Null keys and texts are records like any other; an empty table gives no rows.
    Columns must be orderable (no maps): buckets are sorted before they are shuffled, so a lost task gives the same
    order again.  Clashing names don't matter: the columns stay within the struct.
    """
    record = F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("record")
    mark = F.xxhash64(F.lit(seed), F.col(key), F.col(text))
    placed = records.select(shard_of(key, shards, seed).alias("shard"), mark.alias("mark"), record_bytes(text).alias("size"), record)
    total = placed.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))
    dealt = placed.withColumn("bucket", F.pmod("mark", F.lit(buckets)))
    sizes = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    earlier = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select("shard", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    gathered = (
        dealt.select("shard", "bucket", "mark", "record")
        .repartition("shard", "bucket")
        .groupBy("shard", "bucket")
        .agg(F.sort_array(F.collect_list(F.struct("mark", "record"))).alias("records"))
    )
    ordered = gathered.join(before, ["shard", "bucket"]).sortWithinPartitions("shard", "bucket")
    mixed = ordered.select("shard", "before", F.shuffle("records", F.lit(seed)).alias("records"))
    out = mixed.select("shard", "before", F.posexplode("records").alias("at", "found"))
    return out.select("found.record", "shard", (F.col("before") + F.col("at")).cast("bigint").alias("slot"))


def write_shards(shuffled: DataFrame, path: str) -> None:
    """Write shuffled records as one folder of Parquet files per shard; each file holds a range of slots in order."""
    flat = shuffled.select("record.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    flat.sortWithinPartitions("_shard", "_slot").write.partitionBy("_shard").parquet(path)
