"""Documents that every operator must take: nulls, empties, ties, repeats, clashing names."""

from pyspark.sql import types as T

NAMES = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# Extra columns named like columns that operators use inside or return.
CLASHES = {n: T.StringType() for n in (
    "score", "label", "kept", "keep_id", "shard", "slot", "size", "row", "rk", "id", "copies", "whole", "rank", "n",
    "key", "k", "ids", "held_out", "predicted", "features", "digest", "node", "recipe", "position", "spans", "fold")}


def words(n: int, start: int = 0) -> str:
    return " ".join(f"word{(start + i) * 7919 % 10007}" for i in range(n))


LONG = "\n".join(words(40, 40 * i) for i in range(400))  # 16,000 words
ODD = [
    (1, words(120), "en", "a", 1), (2, words(120), "en", "a", 1), (2, words(120), "en", "a", 1),
    (None, words(120), "en", None, None), (3, None, None, None, None), (4, "", "en", "a", 0),
    (5, " \n\t \x0b", "en", "b", 5), (6, LONG, "en", "b", 1), (7, "x" * 60_000, "en", "b", 1),
    (None, None, None, None, None), (8, "é ß 日本 🙂 ▁ �", "fr", "é", 1),
    (9, words(119) + " other", "en", "a", 1), (10, words(30) + " " + words(89, 31), "en", "c", 1),
]


def documents(spark, rows=None):
    return spark.createDataFrame(ODD if rows is None else rows, SCHEMA)


def with_clashes(spark, rows=None):
    schema = T.StructType(documents(spark, []).schema.fields + [T.StructField(n, t) for n, t in CLASHES.items()])
    return spark.createDataFrame([(*r, *["?"] * len(CLASHES)) for r in (ODD if rows is None else rows)], schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
