"""The registered queries of this package and their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from dockflow.llm import (chunk_dedup, conversation_repair, feistel_shards, language_id, license_scan, mixing, near_dedup, pieces,
                          quality_crf, rules_forest, token_alignment, toxicity, url_filter)
from dockflow.llm.common import table

SPAM_HOSTS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")  # names of the list that op6 judges by
SHARDS = 40


def op4_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op1_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_crf.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "held_out", "score", "predicted", F.size("lines").alias("n_lines"),
                         F.size(F.filter("lines", lambda p: p < 0.5)).alias("n_bad_lines"))


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents")).drop("rk")


def op3_rules_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules_forest.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *rules_forest.COUNTS, "base_failed", "anomaly", "kept")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("spans", "expressions")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.listed_under(pages, SPAM_HOSTS)).drop("possible")


def op7_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = feistel_shards.shard(table(spark, sf_dir, "documents"), SHARDS)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op8_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op9_piece_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(table(spark, sf_dir, "documents"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_ids"),
                          F.md5(F.array_join("ids", ",")).alias("ids_md5"), "round_trip")


def op10_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.withColumns({"n_passages": F.size("passages"), "passage_first": F.col("passages.first_word"),
                               "passage_last": F.col("passages.last_word"), "passage_p": F.col("passages.p")}).drop("passages")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    return conversation_repair.report(conversation_repair.repair(damaged))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_quality_crf, op2_order_minhash, op3_rules_forest, op4_chunk_dedup, op5_license_scan, op6_url_filter,
        op7_feistel_shards, op8_pivotal_mix, op9_piece_scan, op10_toxic_segments, op11_conversation_repair,
        op12_token_alignment, op13_language_id)}
