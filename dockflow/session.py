"""Session settings and the shared work folder."""

import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_work: dict[str, str] = {}

SHUFFLE_INPUT_BYTES = 256 * 1024 ** 2  # input per shuffle partition


def build_session(master: str | None = None, app: str = "dockflow", **conf) -> SparkSession:
    """A session with the settings the jobs are written for.

    AQE coalesces small shuffle partitions, splits skewed ones in joins and
    rebalanced writes, and turns joins into broadcasts by measured size.
    Without `master` the cluster's own setting (spark-submit) is kept.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(input_bytes: int, configured: int) -> int:
    """Partitions for an input: enough that a partition fits in a task's memory."""
    needed = math.ceil(input_bytes / SHUFFLE_INPUT_BYTES)
    return max(configured, needed)


def fit_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Raise the session's shuffle partitions to the input; AQE merges what is too many."""
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fitting = shuffle_partitions(input_bytes, configured)
    if fitting > configured:
        spark.conf.set("spark.sql.shuffle.partitions", fitting)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    `spark.checkpoint.dir` decides. Only a local session without that setting
    gets a temporary folder; a cluster session without it is refused, because a
    driver-local path would be lost with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_work:
        _local_work[app] = tempfile.mkdtemp(prefix="dockflow-")
    return _local_work[app]


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder (not created yet)."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
