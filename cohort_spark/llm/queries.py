"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_spark.llm import lexical_search, near_dup, ngram_join, packing, quality, secrets, sentencepiece_model, sharding, sql, substrings, token_files, top_k, toxicity, whitening
from cohort_spark.llm.registry import ORACLES, QUERIES, query, table
from cohort_spark.session import scratch_path

__all__ = ["ORACLES", "QUERIES"]


SHARDS = 24


@query("op1_quality", sql.QUALITY)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"))


@query("op2_sharding")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    out = sharding.shuffle_into_shards(documents, SHARDS).select("record.doc_id", "record.text", "shard", "slot")
    return out.select(
        "doc_id",
        sharding.record_bytes("text").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        sharding.shard_of("doc_id", SHARDS + 1).alias("grown_shard"),
    )


@query("op3_secrets", sql.SECRETS)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.report(table(spark, folder, "documents"))


@query("op4_top_k", sql.TOP_K)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return top_k.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op5_packing")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


@query("op6_sentencepiece")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_model.round_trip(table(spark, folder, "documents"))


@query("op7_substrings", sql.SUBSTRINGS)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op8_near_duplicates", sql.NEAR_DUPLICATES)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, folder, "documents")).drop("text_hash")


@query("op9_toxicity")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op10_token_files")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_table(table(spark, folder, "documents"), scratch_path(spark, "token-files"))


@query("op11_lexical_search", sql.LEXICAL_SEARCH)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op12_whitening")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


@query("op13_ngram_join", sql.NGRAM_JOIN)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, folder, "documents"))
