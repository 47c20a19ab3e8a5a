import zlib
from collections import Counter

from pyspark.sql import functions as F

from cohort_spark.llm import sharding
from cohort_spark.llm.sharding import shard_of, shuffle_into_shards, write_shards


def rows_of(n):
    rows = [(i, f"text {i % 7} é " * (i % 50)) for i in range(n)]
    return rows + [(None, "x"), (None, None), (3, None), (3, ""), (5, "five"), (5, "five"), *[(77, f"t{i}") for i in range(300)]]


def test_every_record_once_and_slots_without_gaps(spark, docs):
    rows = rows_of(3000)
    df = docs(rows).selectExpr("*", "'a' as shard", "1 as slot", "2 as mark", "3 as bucket")
    out = shuffle_into_shards(df, 7, bucket_bytes=4000)
    got = out.select("record.doc_id", "record.text", "record.shard", "shard", "slot").toDF("doc_id", "text", "old", "shard", "slot").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    assert {r.old for r in got} == {"a"}
    for s in range(7):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots))) and len(slots) > 200
    by_id = {}
    for r in got:
        assert by_id.setdefault(r.doc_id, r.shard) == r.shard
    ordered = [r.doc_id for r in sorted((r for r in got if r.shard == 1 and r.doc_id), key=lambda r: r.slot)]
    rising = sum(a < b for a, b in zip(ordered, ordered[1:]))
    assert 0.35 < rising / len(ordered) < 0.65


def test_one_more_shard_takes_only_into_itself(spark):
    ids = spark.range(5000).select("id", shard_of("id", 24).alias("a"), shard_of("id", 25).alias("b")).collect()
    assert all(r.a == r.b or r.b == 24 for r in ids)
    assert 120 < sum(r.b == 24 for r in ids) < 280
    assert min(Counter(r.a for r in ids).values()) > 140
    assert {r.s for r in spark.range(9).select(shard_of("id", 1).alias("s")).collect()} == {0}


def test_query_columns(spark, given):
    from cohort_spark.llm.queries import QUERIES
    from tests.llm.conftest import FOLDER

    got = {r.doc_id: r for r in QUERIES["op2_sharding"](spark, FOLDER).collect()}
    for r in given("documents").collect():
        body = r.text.encode()
        mine = got[r.doc_id]
        assert (mine.size, mine.text_crc32, mine.law) == (len(body) + 8, zlib.crc32(body), "key")
        assert mine.grown_shard in (mine.shard, 24)


def test_files_and_empty_table(spark, docs, tmp_path):
    path = str(tmp_path / "shards")
    write_shards(shuffle_into_shards(docs(rows_of(200)), 4, bucket_bytes=500), path)
    back = spark.read.parquet(path)
    assert back.count() == len(rows_of(200))
    assert back.groupBy("_shard").agg(F.max("_slot").alias("m"), F.count("*").alias("n")).where("m + 1 <> n").count() == 0
    assert shuffle_into_shards(docs([]), 4).count() == 0
    assert sharding.shuffle_into_shards(docs([(1, None)]), 1).count() == 1
