"""The streaming jobs: changes from polls, views and aggregates from the log.

Handlers apply the batch operators to a micro-batch, so that stream and batch
results agree. Running aggregates use Spark's own streaming state. A job takes its log as
the path of a folder or as a streaming DataFrame of records, such as `sources.kafka.stream_log`.
"""

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from dockflow.functions import station
from dockflow.functions.clock import DEFAULT_TZ, day_bounds, local_date, local_day
from dockflow.operators.activity import activity_minutes
from dockflow.operators.readings import counters, describe
from dockflow.schemas import (COUNTER_DDL, COUNTER_FIELDS, FLOWS_DDL, LOG_DDL, LOG_SCHEMA, MINUTES_DDL, RECORD_DDL,
                              REJECTED_DDL, REJECTED_POLLS_DDL)
from dockflow.sources import documents, files
from dockflow.sources.log import (check_log, encode_log, good_events, monitor_line,
                                  rejected_records)
from dockflow.streaming.queries import (MAX_FILES, Chain, log_stream, parse_polls, poll_stream, reading_stream,
                                        start_query, state_session, stream_session)
from dockflow.streaming.station_state import changes_in_order, last_readings
from dockflow.streaming.tables import BatchTable, BucketView, DatedTable, UpdateTable

POLL_INTERVAL = "60 seconds"
DELAY = "10 minutes"  # how far behind the newest poll one may land
REPEATS = ["station_id", "ts", "offset"]  # records that agree in these are one record that came again
RETENTION = "7 days"  # how far a log reaches back
WATERMARK = "25 hours"  # the longest local day
AHEAD_S = 300  # an event this much later than its record, and of a later day, comes from a wrong clock

Log = str | DataFrame


def records_of(spark: SparkSession, log: Log, max_files: int = MAX_FILES,
               since: date | str | None = None) -> DataFrame:
    return log_stream(spark, log, max_files, since) if isinstance(log, str) else log


# --- polls to change events -----------------------------------------------------
class ChangeJob:
    """Change events of landed polls, with the last reading per station as state.

    A first query parses polls and lands the counters of stations that are known by then; a text that is no status
    document goes to `rejected`. A second one keeps the stations' state and compares readings in the order of their
    time, also when polls land out of order, up to `delay` behind the newest one. Its typed events and log records go to
    tables that other jobs read, the log below the local publish date; `publish` may send the records to a topic as
    well. A restart reports no station again. Events come when the newest poll, with or without stations,
    is `delay` ahead.
    """

    def __init__(self, spark: SparkSession, base: str, info: Callable[[], DataFrame],
                 tz: str = DEFAULT_TZ, delay: str = DELAY, state_partitions: int | None = None,
                 publish: Callable[[DataFrame, int], None] | None = None):
        self.spark, self.base, self.info, self.tz = spark, base, info, tz
        self.delay, self.publish = delay, publish
        self.session = state_session(spark, state_partitions)
        self.readings = BatchTable(spark, f"{base}/readings", COUNTER_DDL)
        self.rejected = BatchTable(spark, f"{base}/rejected", REJECTED_POLLS_DDL)
        self.changes = BatchTable(spark, f"{base}/changes", RECORD_DDL)
        self.log = DatedTable(spark, f"{base}/log", LOG_DDL)

    def land(self, texts: DataFrame, batch_id: int) -> None:
        # Information is read anew for each batch; a broken document has no rows.
        polls = parse_polls(texts).persist()
        good = F.col("lastUpdatedOther").isNotNull() & F.col("data.stations").isNotNull()
        self.rejected.write(polls.where(~good).select(F.col("text").alias("value")), batch_id)
        known = self.info().select("station_id")
        states = counters(documents.status_scan(polls.where(good))).join(known, "station_id", "left_semi")
        clock = polls.where(good).agg(F.max("lastUpdatedOther").alias("ts")).where("ts IS NOT NULL")
        self.readings.write(states.select(*COUNTER_FIELDS).unionByName(clock, allowMissingColumns=True), batch_id)
        polls.unpersist()

    def emit(self, events: DataFrame, batch_id: int) -> None:
        # Written once and read from there: each use of the batch itself runs the state operator anew.
        # A batch in which only the watermark moved has no input, so Spark takes its events for none and would
        # broadcast them through the driver; a merge join moves both sides among executors only.
        self.changes.write(describe(events.hint("merge"), self.info()), batch_id)
        records = encode_log(self.changes.batch(batch_id))
        self.log.write(records.withColumn("date", local_date(F.col("publish_ts"), self.tz)), batch_id)
        if self.publish:
            self.publish(records, batch_id)

    def start(self, polls_path: str, interval: str | None = None, max_files: int = MAX_FILES) -> Chain:
        landing = start_query(poll_stream(self.spark, polls_path, max_files), self.land,
                              f"{self.base}/checkpoint", interval)
        if interval is None:
            landing.awaitTermination()
        files.make_dir(self.spark, self.readings.base)
        readings = reading_stream(self.session, self.readings.base, max_files)
        detecting = start_query(changes_in_order(readings, self.delay), self.emit, self.state_path(), interval)
        return Chain(landing, detecting)

    def state_path(self) -> str:
        """The checkpoint of the query that holds the state."""
        return f"{self.base}/state"

    def last_readings(self) -> DataFrame:
        """The last reading per station, as the state holds it."""
        return last_readings(self.session, self.state_path())


# --- log to tables and views ------------------------------------------------------
def first_of_repeats(checked: DataFrame) -> DataFrame:
    """Checked records without those that came before, good or not.

    Two good records are the same if station, time and offset agree, two bad ones if value and offset do. The keys of
    RETENTION are kept; a record that lies further behind the newest one than a log reaches is left out.
    """
    keyed = checked.withColumns({
        "station_id": F.col("event.station_id"), "ts": F.col("event.ts"),
        "poison": F.when(F.col("reason").isNotNull(), F.col("value")),
        "record_time": F.timestamp_seconds("publish_ts")}).withWatermark("record_time", RETENTION)
    return keyed.dropDuplicatesWithinWatermark([*REPEATS, "poison"]).select(*checked.columns)


class LogJob:
    """Hands decoded events to a handler, each once; rejected records go to a dead-letter table.

    A broken record never stops the stream: the position moves past it. A handler that repeats do not
    matter to may say so (`repeats`), which saves the state.
    """

    def __init__(self, spark: SparkSession, base: str,
                 handler: Callable[[DataFrame, int], None] | None = None, repeats: bool = False,
                 state_partitions: int | None = None):
        self.spark, self.base, self.repeats = spark, base, repeats
        self.session = stream_session(spark) if repeats else state_session(spark, state_partitions)
        self.events = BatchTable(spark, f"{base}/events", RECORD_DDL)
        self.rejected = BatchTable(spark, f"{base}/rejected", REJECTED_DDL)
        self.handler = handler or self.events.write

    def handle(self, checked: DataFrame, batch_id: int) -> None:
        checked = checked.persist()
        self.handler(good_events(checked), batch_id)
        self.rejected.write(rejected_records(checked), batch_id)
        checked.unpersist()

    def start(self, log: Log, interval: str | None = None,
              max_files: int = MAX_FILES) -> StreamingQuery:
        checked = check_log(records_of(self.session, log, max_files))
        return start_query(checked if self.repeats else first_of_repeats(checked), self.handle,
                           f"{self.base}/checkpoint", interval)


def latest_view_job(spark: SparkSession, base: str, buckets: int = 64) -> tuple[LogJob, BucketView]:
    """The view of latest states: whole rows replaced per station, replay changes nothing."""
    view = BucketView(spark, f"{base}/latest", RECORD_DDL, "station_id", ["ts", "offset"], buckets)
    return LogJob(spark, base, view.upsert, repeats=True), view


def start_monitor(spark: SparkSession, log: Log, checkpoint: str,
                  max_files: int = MAX_FILES) -> StreamingQuery:
    """Prints one line per event; a partition of a micro-batch is at the driver at a time."""
    def show(lines: DataFrame, batch_id: int) -> None:
        for row in lines.sort("offset").toLocalIterator():
            print(row["line"], flush=True)

    good = good_events(check_log(records_of(spark, log, max_files)))
    return start_query(monitor_line(good), show, checkpoint)


# --- running aggregates -----------------------------------------------------------
class DayJob:
    """A running aggregate of the current local day, by event time.

    Windows older than the watermark leave the state; each batch adds its updates and reads nothing. The view is the last
    update of each key and starts afresh when an event of the next local day arrives. A record that comes again, with the
    same station, time and offset, counts once. Events far later than their own record and beyond its local day are
    left out, so a wrong clock cannot end the day; within that day all events count, as in batches.
    """

    def __init__(self, spark: SparkSession, base: str, schema: str, key: list[str], tz: str,
                 state_partitions: int):
        self.spark, self.base, self.tz = spark, base, tz
        self.session = state_session(spark, state_partitions)
        self.updates = UpdateTable(spark, base, schema, key)

    def aggregate(self, timed: DataFrame) -> DataFrame:
        raise NotImplementedError

    def handle(self, updates: DataFrame, batch_id: int) -> None:
        rows = updates.select(F.unix_timestamp("window.start").alias("t"),
                              *[c for c in updates.columns if c != "window"])
        self.updates.write(rows, batch_id, self.of_newest_day)

    def of_newest_day(self, rows: DataFrame) -> DataFrame:
        newest = rows.agg(F.max("t")).first()[0]
        return rows if newest is None else rows.where(F.col("t") >= day_bounds(local_day(newest, self.tz), self.tz)[0])

    def view(self) -> DataFrame:
        """The rows of the newest local day, as they are now."""
        return self.of_newest_day(self.updates.read())

    def start(self, log: Log, interval: str | None = None, max_files: int = MAX_FILES,
              since: date | str | None = None) -> StreamingQuery:
        """From the beginning of the log, or from a publish date, where a day's work begins."""
        good = good_events(check_log(records_of(self.session, log, max_files, since)))
        own_day = local_date(F.col("ts"), self.tz) <= local_date(F.col("publish_ts"), self.tz)
        timed = good.where(own_day | (F.col("ts") <= F.col("publish_ts") + AHEAD_S)).withColumn(
            "event_time", F.timestamp_seconds("ts")).withWatermark("event_time", WATERMARK)
        return start_query(self.aggregate(timed.dropDuplicatesWithinWatermark(REPEATS)), self.handle, f"{self.base}/checkpoint", interval,
                           "update")


class FlowsJob(DayJob):
    """Bikes taken and returned per station today, as quarter hours, which end with any local day."""

    def __init__(self, spark: SparkSession, base: str, tz: str = DEFAULT_TZ, *,
                 state_partitions: int):
        super().__init__(spark, base, f"t bigint, {FLOWS_DDL}", ["t", "station_id"], tz, state_partitions)

    def aggregate(self, timed: DataFrame) -> DataFrame:
        delta = F.col("bikes_delta")
        return timed.where(delta != 0).groupBy(F.window("event_time", "15 minutes"), "station_id").agg(
            F.sum(station.taken(delta)).alias("taken"),
            F.sum(station.returned(delta)).alias("returned"))

    def flows(self) -> DataFrame:
        return self.view().groupBy("station_id").agg(
            F.sum("taken").alias("taken"), F.sum("returned").alias("returned"))


class ActivityJob(DayJob):
    """Minute buckets of the current local day."""

    def __init__(self, spark: SparkSession, base: str, tz: str = DEFAULT_TZ, *,
                 state_partitions: int):
        super().__init__(spark, base, MINUTES_DDL, ["t"], tz, state_partitions)

    def aggregate(self, timed: DataFrame) -> DataFrame:
        delta = F.col("bikes_delta")
        return timed.groupBy(F.window("event_time", "1 minute")).agg(
            F.count("*").alias("events"), F.sum(station.taken(delta)).alias("taken"),
            F.sum(station.returned(delta)).alias("returned"))

    def minutes(self) -> DataFrame:
        return self.view()


# --- replay and live feed -----------------------------------------------------------
class RelayJob:
    """Rebuilds the day from the log, then follows it.

    Both phases share one checkpoint and begin at the day's records; a record that comes again counts and goes out once. Replayed records feed the
    minute buckets only; good records that arrive afterwards go to the live feed as well, whole and
    as they are.
    """

    def __init__(self, spark: SparkSession, base: str, day: date | str, tz: str = DEFAULT_TZ,
                 state_partitions: int | None = None):
        self.spark, self.base, self.day, self.tz = spark, base, day, tz
        self.session = state_session(spark, state_partitions)
        self.partials = BatchTable(spark, f"{base}/minutes", MINUTES_DDL)
        self.feed = BatchTable(spark, f"{base}/feed", LOG_DDL)

    def _start(self, log: Log, live: bool, interval: str | None, max_files: int) -> StreamingQuery | None:
        if isinstance(log, str) and not files.exists(self.spark, log):
            return None  # no log: the caller goes on with snapshot and archives only
        start, _ = day_bounds(self.day, self.tz)

        def handle(checked: DataFrame, batch_id: int) -> None:
            checked = checked.persist()
            self.partials.write(activity_minutes(good_events(checked), self.day, self.tz), batch_id)
            if live:
                good = checked.where(F.col("reason").isNull())
                self.feed.write(good.select(*LOG_SCHEMA.fieldNames()), batch_id)
            checked.unpersist()

        records = records_of(self.session, log, max_files, self.day).where(F.col("publish_ts") >= start)
        return start_query(first_of_repeats(check_log(records)), handle, f"{self.base}/checkpoint", interval)

    def replay(self, log: Log, max_files: int = MAX_FILES) -> StreamingQuery | None:
        """Everything in the log up to now, without the live feed."""
        return self._start(log, False, None, max_files)

    def follow(self, log: Log, interval: str | None = None,
               max_files: int = MAX_FILES) -> StreamingQuery | None:
        """What came after the replay."""
        return self._start(log, True, interval, max_files)

    def minutes(self) -> DataFrame:
        return self.partials.read().groupBy("t").agg(
            *[F.sum(c).alias(c) for c in ("events", "taken", "returned")])
