"""Helpers that the operators of this package share."""

import atexit
import contextlib
import math
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from dockflow.session import new_dir
from dockflow.sources import files

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


_folders: dict[str, str] = {}  # by application: where its settled tables lie


def settle(df: DataFrame) -> DataFrame:
    """The rows, computed once and written as a table in the folder that all executors share.

    A later read does not depend on an executor's own files, the plan that led here is cut off, and the
    table's size is known. (A checkpoint would keep the size estimated before it, which grows with each
    join of an iteration until the number itself is too long to handle.) Tables go when the
    application ends, or with `release`.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    if app not in _folders:
        _folders[app] = new_dir(spark, "settled")
        atexit.register(_clean, spark, _folders[app])
    path = f"{_folders[app]}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.settled_path = path
    return kept


def _clean(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Py4JError, ConnectionError):  # the JVM may have ended before
        files.delete(spark, path)


def release(*tables: DataFrame | None) -> None:
    """Remove settled tables that nothing will read again."""
    for table in tables:
        if table is not None:
            files.delete(table.sparkSession, table.settled_path)


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextlib.contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """What is run inside passes rows to Python in batches of about so many bytes, a longer row on its own.

    Spark's own limit is 10,000 rows or 64 MB, of which a task holds several copies on either side. The session's setting
    comes back in the end, so a table has to be settled or collected inside.
    """
    before = spark.conf.get(BATCH, None)
    spark.conf.set(BATCH, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH)
        else:
            spark.conf.set(BATCH, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, n: int) -> Column:
    """crc32 of the column as text, modulo n; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % n


def word_count(text: str) -> Column:
    """Number of words; null counts as empty."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def unit(*parts) -> Column:
    """A number from 0 up to but not 1, fixed by the parts."""
    bits = F.shiftrightunsigned(F.xxhash64(*parts), 11)
    return bits / F.lit(float(2 ** 53))


def smallest(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """The n rows with the smallest hashes of their key (all, if there are fewer).

    Tasks only pass on rows below a hash that little more than n rows lie under, so that what meets in
    one place does not grow with the number of tasks.
    """
    total = df.count()
    hashed = df.withColumn("_hash", F.xxhash64(F.lit(seed), key))
    if total > n:
        share = min(1.0, (1.1 * n + 10 * math.sqrt(n) + 20) / total)
        hashed = hashed.filter(F.col("_hash") <= min(2 ** 63 - 1, int(share * 2 ** 64) - 2 ** 63))
    return hashed.orderBy("_hash", key).limit(n).drop("_hash")


def row_key(df: DataFrame) -> Column:
    """Fingerprint of a whole row. Rows that agree in every column share it."""
    named = [F.col(f"`{c}`") for c in df.columns]
    return F.xxhash64(*[c.isNull() for c in named], *named)


def same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Equality of the columns in which nulls are equal."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & left[c].eqNullSafe(right[c])
    return condition


def packed(docs: DataFrame, *keys: Column) -> DataFrame:
    """Each row as one struct `whole` beside its keys, so that no names can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), *keys)


def unpacked(rows: DataFrame, copies: DataFrame, keys: list[str]) -> DataFrame:
    """The packed rows, as many times as `copies` says for their keys; a missing key drops them.

    Rows with equal keys are interchangeable: n of them share the copies c as evenly as
    whole numbers allow.
    """
    found = rows.join(copies, same(rows, copies, keys)).select(
        *[rows[c] for c in rows.columns], copies["copies"])
    by_key = Window.partitionBy(*keys)
    rank = F.row_number().over(by_key.orderBy(*keys))
    n = F.count("*").over(by_key)
    return (found.withColumn("rank", rank).withColumn("n", n)
            .withColumn("own", F.expr("(copies - rank + n) div n")).filter("own > 0")
            .select("whole", F.explode(F.expr("sequence(1L, own)"))).select("whole.*"))
