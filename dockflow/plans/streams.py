"""Registered streaming queries: land the derived tables in slices, one micro-batch each.

Every slice is landed and then worked off by a query that is started anew from
its checkpoint, as a series of polls with restarts in between.
"""

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from dockflow.functions.clock import day_bounds, local_date
from dockflow.plans import bindings
from dockflow.plans.derived import Derived
from dockflow.session import new_dir
from dockflow.sources.log import decode_log, encode_log
from dockflow.streaming import jobs

_HOUR = 3600
RECORDS_PER_FILE = 100_000  # of a landed log: a file's row group is read by one task


def _days(d: Derived) -> list[int]:
    """Cuts around the reference day, for queries over the whole log."""
    start, end = day_bounds(d.day, d.tz)
    return [start - 5 * 24 * _HOUR, end + 5 * 24 * _HOUR]


def _hours(d: Derived) -> list[int]:
    """Cuts within the reference day, for queries of the day."""
    start, _ = day_bounds(d.day, d.tz)
    return [start, start + 12 * _HOUR]


def _slices(rows: DataFrame, column: str, cuts: list[int]) -> list[DataFrame]:
    edges = [None, *cuts, None]
    out = []
    for low, high in zip(edges, edges[1:]):
        part = rows
        if low is not None:
            part = part.where(F.col(column) >= low)
        if high is not None:
            part = part.where(F.col(column) < high)
        out.append(part)
    return out


def _twice(rows: DataFrame) -> DataFrame:
    """Each row two times; a union with itself would compute the rows two times as well."""
    return rows.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")


def _run(slices: list[DataFrame], path: str, start: Callable[[str], object]) -> None:
    """Each slice lands twice, and once more with the next one."""
    for before, rows in zip([None, *slices], slices):
        rows = _twice(rows)
        rows = rows.unionByName(before) if before is not None else rows
        writer = rows.write.mode("append").option("maxRecordsPerFile", RECORDS_PER_FILE)
        (writer.partitionBy("date") if "date" in rows.columns else writer).parquet(path)
        start(path).awaitTermination()


def _log_table(rows: DataFrame, d: Derived) -> DataFrame:
    """Log records below their publish date, as the change job writes them."""
    return rows.withColumn("date", local_date(F.col("publish_ts"), d.tz))


def _of_the_day(d: Derived) -> DataFrame:
    """The log as it is when the day ends."""
    return _log_table(encode_log(d.changes()), d).where(F.col("publish_ts") < day_bounds(d.day, d.tz)[1])


STATE_INPUT_BYTES = 4 * 1024 ** 2  # source bytes per partition of a stream's state


def _state_partitions(d: Derived) -> int:
    """They stay as they are once a stream has started, so they are chosen by the input."""
    return max(4, math.ceil(d.source_bytes() / STATE_INPUT_BYTES))


DELAY_HOURS = 36  # of polls behind the newest one
POLLS_PER_FILE = 10_000  # a task reads a landed file as one text, so its size is bounded


def _change_job(d: Derived) -> jobs.ChangeJob:
    """Polls land up to DELAY_HOURS late and so out of order; a last one without stations moves the clock."""
    def job(base: str) -> jobs.ChangeJob:
        return jobs.ChangeJob(d.spark, base, d.info, d.tz, f"{DELAY_HOURS} hours", state_partitions=_state_partitions(d))

    def work(base: str) -> None:
        path = new_dir(d.spark, "polls")
        polls = bindings.status_documents(d.facts())
        late = F.pmod(F.xxhash64("offset"), F.lit(DELAY_HOURS * _HOUR))
        arriving = polls.withColumn("arrival", F.col("lastUpdatedOther") + late)
        ahead = (F.max("lastUpdatedOther") + DELAY_HOURS * _HOUR + 1).alias("lastUpdatedOther")
        end = polls.agg(ahead).withColumn("data", F.struct(F.expr("array()").alias("stations")))
        for rows in [*_slices(arriving, "arrival", _days(d)), end]:
            rows.drop("arrival").write.mode("append").option("maxRecordsPerFile", POLLS_PER_FILE).json(path)
            job(base).start(path).awaitTermination()

    return job(d.folder("stream-changes", work))


def stream_changes(d: Derived) -> DataFrame:
    return _change_job(d).changes.read().drop("batch_id")


def stream_state(d: Derived) -> DataFrame:
    """The last reading per station, read from the state of the change job."""
    return _change_job(d).last_readings()


def stream_log_source(d: Derived) -> DataFrame:
    job = jobs.LogJob(d.spark, new_dir(d.spark, "stream-log"))
    log = bindings.damaged_log(encode_log(d.changes()))
    _run(_slices(log, "publish_ts", _days(d)), new_dir(d.spark, "log"), job.start)
    return job.events.read().drop("batch_id")


def stream_latest_view(d: Derived) -> DataFrame:
    job, view = jobs.latest_view_job(d.spark, new_dir(d.spark, "stream-latest"))
    _run(_slices(encode_log(d.changes()), "publish_ts", _hours(d)), new_dir(d.spark, "log"), job.start)
    return view.read().drop("offset", "publish_ts")


def _day_job(d: Derived, kind: type[jobs.DayJob], name: str) -> jobs.DayJob:
    job = kind(d.spark, new_dir(d.spark, name), d.tz, state_partitions=4)
    _run(_slices(_of_the_day(d), "publish_ts", _hours(d)), new_dir(d.spark, "log"),
         lambda path: job.start(path, since=d.day))
    return job


def stream_flows(d: Derived) -> DataFrame:
    return _day_job(d, jobs.FlowsJob, "stream-flows").flows()


def stream_activity(d: Derived) -> DataFrame:
    return _day_job(d, jobs.ActivityJob, "stream-activity").minutes()


def stream_push(d: Derived) -> DataFrame:
    """The live feed from the first record of the day on."""
    job = jobs.RelayJob(d.spark, new_dir(d.spark, "stream-push"), d.day, d.tz)
    _run(_slices(_log_table(encode_log(d.changes()), d), "publish_ts", _hours(d)),
         new_dir(d.spark, "log"), job.follow)
    return job.feed.read().drop("batch_id")


def stream_replay_live(d: Derived) -> DataFrame:
    """Minute buckets of the day, with how many of each minute's events went to the live feed."""
    job = jobs.RelayJob(d.spark, new_dir(d.spark, "stream-relay"), d.day, d.tz)
    past, live = _slices(_log_table(encode_log(d.changes()), d), "publish_ts", _hours(d)[1:])
    path = new_dir(d.spark, "log")
    _twice(past).write.option("maxRecordsPerFile", RECORDS_PER_FILE).partitionBy("date").parquet(path)
    job.replay(path).awaitTermination()
    (_twice(live).unionByName(past).write.mode("append").option("maxRecordsPerFile", RECORDS_PER_FILE)
     .partitionBy("date").parquet(path))
    job.follow(path).awaitTermination()
    minute = (F.col("ts") - F.pmod("ts", F.lit(60))).alias("t")
    fed, _ = decode_log(job.feed.read())
    pushed = fed.groupBy(minute).agg(F.count("*").alias("pushed"))
    return job.minutes().join(pushed, "t", "left").withColumn(
        "pushed", F.coalesce("pushed", F.lit(0)))


STREAMS = {
    "stream_changes": stream_changes,
    "stream_state": stream_state,
    "stream_log_source": stream_log_source,
    "stream_latest_view": stream_latest_view,
    "stream_flows": stream_flows,
    "stream_activity": stream_activity,
    "stream_push": stream_push,
    "stream_replay_live": stream_replay_live,
}
