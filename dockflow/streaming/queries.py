"""Stream sources and the start of a query."""

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from dockflow.schemas import COUNTER_DDL, COUNTER_FIELDS, LOG_SCHEMA, LOG_TABLE_DDL, STATUS_SCHEMA
from dockflow.sources import documents

# Status documents as landed by the poller, with optional record metadata.
POLL_SCHEMA = T.StructType(list(STATUS_SCHEMA.fields) + [
    T.StructField("offset", T.LongType()), T.StructField("publish_ts", T.LongType())])

MAX_FILES = 1000  # new files of a micro-batch, unless the caller says otherwise


def log_stream(spark: SparkSession, path: str, max_files: int = MAX_FILES,
               since: date | str | None = None) -> DataFrame:
    """The change log as a folder of records, from its beginning or from a publish date.

    `max_files` bounds a micro-batch; the position is kept in the checkpoint.
    A batch the writer repeated has new files in place of old ones; those are
    skipped, so a record may come twice but none is missing. Folders of earlier dates are not
    opened; records that lie below no date are all read.
    """
    rows = (spark.readStream.schema(LOG_TABLE_DDL).option("ignoreMissingFiles", True)
            .option("maxFilesPerTrigger", max_files).parquet(path))
    if since is not None:
        rows = rows.where(F.col("date").isNull() | (F.col("date") >= F.lit(str(since)).cast("date")))
    return rows.select(*LOG_SCHEMA.fieldNames())


def poll_stream(spark: SparkSession, path: str, max_files: int = MAX_FILES) -> DataFrame:
    """Text of landed status documents (`value`): any number in a file, indented or one per line."""
    files = spark.readStream.option("maxFilesPerTrigger", max_files).text(path, wholetext=True)
    return documents.split_documents(files)


def reading_stream(spark: SparkSession, path: str, max_files: int = MAX_FILES) -> DataFrame:
    """Counters that a landing job wrote batch by batch."""
    rows = (spark.readStream.schema(f"{COUNTER_DDL}, batch_id bigint").option("ignoreMissingFiles", True)
            .option("maxFilesPerTrigger", max_files).parquet(path))
    return rows.select(*COUNTER_FIELDS)


def parse_polls(texts: DataFrame) -> DataFrame:
    """Status documents beside their text."""
    return documents.parse_documents(texts.withColumn("text", F.col("value")), POLL_SCHEMA)


def start_query(stream: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str,
                interval: str | None = None, output_mode: str = "append") -> StreamingQuery:
    """Run `handler` on every micro-batch, at least once, from the checkpointed position.

    Without an interval the query works off what is there and ends. Each query
    has its own checkpoint and so its own position in the log.
    """
    writer = (stream.writeStream.foreachBatch(handler).outputMode(output_mode)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(
        processingTime=interval)
    return writer.start()


SPLIT_BYTES = "16m"  # of log files to a task: as text and decoded, records take tens of times what they take in Parquet


def stream_session(spark: SparkSession) -> SparkSession:
    """A session of its own for a query over a log, whose tasks read little at a time however large the log is."""
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(key, spark.conf.get(key))
    session.conf.set("spark.sql.files.maxPartitionBytes", SPLIT_BYTES)
    return session


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of its own for a query with state, which RocksDB holds.

    The partitions of its state stay as they were at the first start, so they are chosen for the
    job and set where no other query sees them.
    """
    session = stream_session(spark)
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    if state_partitions:
        session.conf.set("spark.sql.shuffle.partitions", state_partitions)
    return session


class Chain:
    """Queries of which each reads what the one before it wrote."""

    def __init__(self, *queries: StreamingQuery):
        self.queries = queries

    @property
    def isActive(self) -> bool:  # noqa: N802, as a query names it
        return any(q.isActive for q in self.queries)

    def awaitTermination(self) -> None:  # noqa: N802
        """Until all have ended; if one fails, the others are stopped and its error is raised."""
        try:
            while self.isActive:
                for query in self.queries:
                    query.awaitTermination(1)
            for query in self.queries:
                query.awaitTermination()
        except Exception:
            self.stop()
            raise

    def stop(self) -> None:
        for query in self.queries:
            query.stop()
