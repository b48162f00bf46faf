"""The corpus pipeline: quality, exact copies, near copies, mix, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next stage's docs.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from dockflow.llm import chunk_dedup, mixing, near_dedup, pieces, quality_crf
from dockflow.llm.common import table
from dockflow.session import new_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier accepts."""
    return quality_crf.accepted(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts, the one with the largest id."""
    return chunk_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest id."""
    return near_dedup.kept_rows(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids and round_trip of every document of the mix."""
    return pieces.encode(docs).select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mix", mix), ("encode", encode)]

ORACLE_SQL = None  # classifier, sketches and lattice search are tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = new_dir(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
