"""Tables that micro-batches write idempotently.

Every write goes to the folder of its batch id and replaces it. A batch that is
run again after a lost executor or a restart therefore changes nothing.
"""

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from dockflow.operators.state import latest_by
from dockflow.sources import files


class BatchTable:
    """Rows added batch by batch."""

    def __init__(self, spark: SparkSession, base: str, schema: str):
        self.spark, self.base, self.schema = spark, base, schema

    def path(self, batch_id: int) -> str:
        return f"{self.base}/batch_id={batch_id}"

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(self.path(batch_id))

    def batch(self, batch_id: int) -> DataFrame:
        """The rows of one batch."""
        return files.read_or_empty(self.spark, self.path(batch_id), self.schema)

    def read(self) -> DataFrame:
        """All rows, with the batch that wrote them as `batch_id`."""
        return files.read_or_empty(self.spark, self.base, f"{self.schema}, batch_id bigint")


class DatedTable(BatchTable):
    """Rows added batch by batch below their `date`, so that a day is read alone.

    A repeated batch has the same rows and so replaces its own folder of each date.
    """

    def write(self, rows: DataFrame, batch_id: int) -> None:
        (rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("date", "batch_id").parquet(self.base))

    def read(self) -> DataFrame:
        return files.read_or_empty(self.spark, self.base, f"{self.schema}, date date, batch_id bigint")


class BucketView:
    """One row per key, in buckets by the key's hash; a batch rewrites the buckets that it touches and no others.

    A manifest of each batch names the batch that wrote every live bucket. It appears whole or not at all after the
    buckets are written, so readers see the view before or after a batch. The last two manifests and what they
    name are kept: a repeated batch starts from the manifest before it and replaces its own buckets. A manifest
    that should be there and is not is an error: going on without it would lose the view's rows.
    """

    def __init__(self, spark: SparkSession, base: str, schema: str, key: str, order: list[str], buckets: int = 64):
        self.spark, self.base, self.schema, self.key, self.order, self.buckets = spark, base, schema, key, order, buckets

    def _manifest(self, batch_id: int) -> dict[str, int]:
        if batch_id < 0:
            return {}
        return json.loads(files.read_text(self.spark, f"{self.base}/manifests/{batch_id}.json"))

    def _read(self, live: dict[str, int]) -> DataFrame:
        paths = [f"{self.base}/batch={batch}/bucket={bucket}" for bucket, batch in live.items()]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def upsert(self, rows: DataFrame, batch_id: int) -> None:
        """Keep the last row per key, by the view's order, among the view's rows and the new ones."""
        before = self._manifest(batch_id - 1)
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets))
        fresh = latest_by(rows, self.key, self.order).persist()
        touched = [str(r[0]) for r in fresh.select(bucket).distinct().collect()]  # buckets at most
        merged = self._read({b: before[b] for b in touched if b in before}).unionByName(fresh.select(*names_of(self.schema)))
        path = f"{self.base}/batch={batch_id}"
        (latest_by(merged, self.key, self.order).withColumn("bucket", bucket).repartition("bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(path))
        fresh.unpersist()
        now = before | dict.fromkeys(touched, batch_id)
        files.make_dir(self.spark, f"{self.base}/manifests")
        files.write_text(self.spark, f"{self.base}/manifests/{batch_id}.json", json.dumps(now))
        self._clean(batch_id, {*before.values(), *now.values()})

    def _clean(self, batch_id: int, named: set[int]) -> None:
        """Remove manifests before the last two, and batches of which no bucket is named any more."""
        files.delete(self.spark, f"{self.base}/manifests/{batch_id - 2}.json")
        for name in files.names(self.spark, self.base):
            if name.startswith("batch=") and int(name[6:]) < batch_id and int(name[6:]) not in named:
                files.delete(self.spark, f"{self.base}/{name}")

    def read(self) -> DataFrame:
        """The view after the newest batch; empty before the first."""
        found = [int(n[:-5]) for n in files.names(self.spark, f"{self.base}/manifests") if n.endswith(".json")]
        return self._read(self._manifest(max(found, default=-1)))


class UpdateTable:
    """Updates of keyed rows, batch by batch; the last one of a key counts. Nothing is read to write.

    Every COMPACT batches the current rows are written once more as a whole, and what they replace is deleted.
    """

    COMPACT = 50

    def __init__(self, spark: SparkSession, base: str, schema: str, key: list[str]):
        self.spark, self.base, self.schema, self.key = spark, base, schema, key

    def _compacted(self) -> int:
        return files.newest_version(self.spark, f"{self.base}/compacted")

    def write(self, rows: DataFrame, batch_id: int, keep: Callable[[DataFrame], DataFrame]) -> None:
        """`keep` picks the rows that a compaction takes over."""
        if self._compacted() >= batch_id:
            return  # a repeated batch that is in there
        rows.write.mode("overwrite").parquet(f"{self.base}/updates/batch_id={batch_id}")
        if batch_id % self.COMPACT == self.COMPACT - 1:
            keep(self.read()).write.mode("overwrite").parquet(f"{self.base}/compacted/v={batch_id}")
            for name in files.names(self.spark, f"{self.base}/updates"):
                if int(name.removeprefix("batch_id=")) <= batch_id:
                    files.delete(self.spark, f"{self.base}/updates/{name}")
            for name in files.names(self.spark, f"{self.base}/compacted"):
                if int(name.removeprefix("v=")) < batch_id:
                    files.delete(self.spark, f"{self.base}/compacted/{name}")

    def read(self) -> DataFrame:
        whole = self._compacted()
        ddl = f"{self.schema}, batch_id bigint"
        updates = files.read_or_empty(self.spark, f"{self.base}/updates", ddl).where(F.col("batch_id") > whole)
        if whole >= 0:
            old = self.spark.read.schema(self.schema).parquet(f"{self.base}/compacted/v={whole}")
            updates = updates.unionByName(old.withColumn("batch_id", F.lit(whole).cast("bigint")))
        others = [c for c in updates.columns if c not in self.key]
        last = updates.groupBy(*self.key).agg(F.max_by(F.struct(*others), "batch_id").alias("row"))
        return last.select(*self.key, *[f"row.{c}" for c in others if c != "batch_id"])


def names_of(schema: str) -> list[str]:
    return T.StructType.fromDDL(schema).fieldNames()
