"""Exact deduplication by recipes of content-defined chunks.

A text is cut where its own characters say so, so equal texts have equal chunks. Each
distinct chunk moves through one shuffle, where its identifier is verified: no two different
chunks may share one. From then on a document is the ordered list of its identifiers, and two
documents are equal exactly when their lists are.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from dockflow.llm.common import packed, settle, unpacked

MIN_CHUNK, MAX_CHUNK = 512, 8192  # characters; the mean lies near 1,200 for prose

# A cut follows three characters from these classes of code points, about once in 700
# characters of prose. Where none follows, a chunk ends at the largest size.
CUT = r"(?<=[aiqyAIQY19!)][bjrzBJRZ2:*][dltDLT4<,\x20.])"

Fingerprint = Callable[[Column, int], tuple[Column, Column]]


def wide_fingerprint(chunk: Column, attempt: int) -> tuple[Column, Column]:
    """128 bits of a chunk, others with each attempt."""
    return (F.xxhash64(F.lit(2 * attempt), chunk), F.xxhash64(F.lit(2 * attempt + 1), chunk))


def chunks(text: Column) -> Column:
    """The chunks of a text in order; together they are the text."""
    pattern = f"(?s).{{{MIN_CHUNK},{MAX_CHUNK - 1}}}?{CUT}|(?s).{{1,{MAX_CHUNK}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def verified(texts: DataFrame, text_col: str, attempt: int, fingerprint: Fingerprint) -> bool:
    """Whether different chunks have different identifiers.

    Equal chunks are combined before the shuffle, so each distinct chunk moves once per task.
    """
    pieces = texts.select(F.explode(chunks(F.col(text_col))).alias("chunk"))
    a, b = fingerprint(F.col("chunk"), attempt)
    pairs = pieces.select(a.alias("a"), b.alias("b"), "chunk").distinct()
    return pairs.groupBy("a", "b").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()


def with_recipe(docs: DataFrame, text_col: str, attempt: int, fingerprint: Fingerprint) -> DataFrame:
    """Add `recipe`, the identifiers of the text's chunks in order, as one list of longs."""
    halves = [F.transform("pieces", lambda c: fingerprint(c, attempt)[0]),
              F.transform("pieces", lambda c: fingerprint(c, attempt)[1])]
    cut = docs.withColumn("pieces", chunks(F.coalesce(F.col(text_col), F.lit(""))))
    return cut.withColumn("recipe", F.concat(*halves)).drop("pieces")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 fingerprint: Fingerprint = wide_fingerprint) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays; of several such rows, one. A null text
    counts as empty. A null id stays only where a group has no other id. An empty table
    gives no rows; other columns of docs are not read. If an identifier stands for two
    different chunks, all are drawn anew.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    attempt = 0
    while not verified(texts, "text", attempt, fingerprint):
        attempt += 1
    lists = with_recipe(texts, "text", attempt, fingerprint).select(
        "doc_id", "recipe", F.sha2(F.col("text"), 256).alias("text_sha256"))
    rows = settle(lists.groupBy("recipe", "doc_id", "text_sha256").agg(F.count("*").alias("n")))
    groups = settle(rows.groupBy("recipe").agg(
        F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size"),
        F.count("*").alias("ids")).filter("ids > 1"))
    joined = rows.join(groups.drop("ids"), "recipe", "left")
    alone = F.col("group_size").isNull()
    copies = joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", "n").alias("group_size"), "text_sha256",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"))
    return copies.select("doc_id", "keep_id", "group_size",
                         (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                         "text_sha256")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    stay = exact_groups(docs, id_col, text_col).filter("kept").select("doc_id", "text_sha256")
    return unpacked(packed(docs, F.col(id_col).alias("id"), F.sha2(text, 256).alias("sha")),
                    stay.toDF("id", "sha").withColumn("copies", F.lit(1).cast("long")), ["id", "sha"])
