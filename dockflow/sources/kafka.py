"""The change log on Kafka. Needs Spark's Kafka connector on the classpath."""

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from dockflow.functions.clock import DEFAULT_TZ, day_bounds
from dockflow.sources.log import KAFKA_SINK_OPTIONS


MAX_OFFSETS = 1_000_000  # records of a micro-batch, unless the caller says otherwise


def _records(source: DataFrame) -> DataFrame:
    return source.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "partition", "offset", F.unix_timestamp("timestamp").alias("publish_ts"))


def stream_log(spark: SparkSession, servers: str, topic: str,
               max_offsets: int = MAX_OFFSETS, since: date | str | None = None,
               tz: str = DEFAULT_TZ) -> DataFrame:
    """From the earliest record, or the first of a local day, for a new checkpoint, then from its position."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "maxOffsetsPerTrigger": str(max_offsets)}
    if since is None:
        options["startingOffsets"] = "earliest"
    else:
        options |= {"startingTimestamp": str(day_bounds(since, tz)[0] * 1000),
                    "startingOffsetsByTimestampStrategy": "latest"}
    return _records(spark.readStream.format("kafka").options(**options).load())


def read_days(spark: SparkSession, servers: str, topic: str, first_day: date | str,
              last_day: date | str, tz: str = DEFAULT_TZ) -> DataFrame:
    """Records published in the local days; partitions without any are skipped."""
    start, end = day_bounds(first_day, tz)[0], day_bounds(last_day, tz)[1]
    source = spark.read.format("kafka").options(**{
        "kafka.bootstrap.servers": servers, "subscribe": topic,
        "startingTimestamp": str(start * 1000), "endingTimestamp": str(end * 1000),
        "startingOffsetsByTimestampStrategy": "latest"})
    return _records(source.load())


def publisher(servers: str, topic: str) -> Callable[[DataFrame, int], None]:
    """Sends the encoded records of a micro-batch to a topic, at least once; the views here do not mind repeats or drop them."""
    def publish(records: DataFrame, batch_id: int) -> None:
        (records.select("key", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", servers).option("topic", topic)
         .options(**KAFKA_SINK_OPTIONS).save())

    return publish
