"""Date-partitioned Parquet archives of events and weather.

A run replaces exactly the dates it writes, so repeating it changes nothing, and it replaces all of them or none.
One job covers a whole range of days. `REBALANCE` lets AQE split a date that
holds most of the rows over several tasks and merge the small ones.

A run is written to a staging folder first. Then a journal says which dates are about to be exchanged, each
old date is moved aside and its new one into place, and the journal goes. Whoever finds a journal, the run itself
after a failure or the next reader or writer after a crash, moves the old dates back.

Beside the events lie their sums per date and hour, exchanged in the same run; histories read these only.
"""

import json
import uuid
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from dockflow.functions.clock import DEFAULT_TZ, local_date, local_hour
from dockflow.functions.station import returned, taken
from dockflow.schemas import ARCHIVE_EVENT_TYPES, ARCHIVE_WEATHER_TYPES, HOURS_TYPES, ddl
from dockflow.sources import files
from dockflow.sources.files import read_or_empty
from dockflow.sources.log import read_log_days

HOURS = "_hours"  # folder of the sums beside the dates; hidden from readers of the events
JOURNAL = "_exchange.json"


@dataclass
class Run:
    """What a run wrote: its dates, and totals that were counted while it was written."""

    dates: list[str]
    totals: dict[str, float | int | None]


def event_rows(changes: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """The 17 archive columns: `hour` from event time, `date` from publish time."""
    timed = changes.withColumn("hour", local_hour(F.col("ts"), tz)).withColumn(
        "date", local_date(F.col("publish_ts"), tz))
    return timed.select(
        *[F.col(c).cast(kind).alias(c) for c, kind in ARCHIVE_EVENT_TYPES.items()], "date")


def hour_sums(events: DataFrame) -> DataFrame:
    """Events, bikes taken and returned per date and local hour; 24 rows a date."""
    delta = F.col("bikes_delta").cast("int")
    return events.groupBy("date", "hour").agg(
        F.count("*").alias("events"), F.sum(taken(delta)).alias("taken"), F.sum(returned(delta)).alias("returned"))


def write_partitions(rows: DataFrame, base: str, order: str = "ts") -> None:
    (rows.hint("rebalance", "date")
     .sortWithinPartitions("date", order)
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd")
     .partitionBy("date")
     .parquet(base))


# --- exchange of dates --------------------------------------------------------------
def recover(spark: SparkSession, base: str) -> None:
    """Undo an exchange that did not end."""
    journal = f"{base}/{JOURNAL}"
    if not files.exists(spark, journal):
        return
    found = json.loads(files.read_text(spark, journal))
    for folder in found["folders"]:
        new, live, old = f"{found['staging']}/{folder}", f"{base}/{folder}", f"{found['staging']}-old/{folder}"
        if files.exists(spark, old):
            files.delete(spark, live)
            files.move(spark, old, live)
        elif not files.exists(spark, new):  # moved into a place that was empty
            files.delete(spark, live)
    files.delete(spark, journal)
    files.delete(spark, found["staging"])
    files.delete(spark, f"{found['staging']}-old")


def exchange(spark: SparkSession, staging: str, base: str, folders: list[str]) -> None:
    """Put staged folders in the place of those of the same name, all of them or none."""
    files.write_text(spark, f"{base}/{JOURNAL}", json.dumps({"staging": staging, "folders": folders}))
    try:
        for folder in folders:
            live = f"{base}/{folder}"
            if files.exists(spark, live):
                files.move(spark, live, f"{staging}-old/{folder}")
            files.move(spark, f"{staging}/{folder}", live)
    except Exception:
        recover(spark, base)
        raise
    files.delete(spark, f"{base}/{JOURNAL}")
    files.delete(spark, staging)
    files.delete(spark, f"{staging}-old")


def _write(rows: DataFrame, base: str, schema: str, mirror_base: str | None, totals: dict[str, Column], hours: bool) -> Run:
    spark = rows.sparkSession
    files.make_dir(spark, base)
    recover(spark, base)
    staging = f"{base}/_run-{uuid.uuid4().hex}"
    watch = Observation()
    write_partitions(rows.observe(watch, *[c.alias(name) for name, c in totals.items()]), staging)
    dates = [n for n in files.names(spark, staging) if n.startswith("date=")]
    folders = list(dates)
    if hours and dates:
        write_partitions(hour_sums(read_or_empty(spark, staging, schema)), f"{staging}/{HOURS}", "hour")
        folders += [f"{HOURS}/{d}" for d in dates]
    exchange(spark, staging, base, folders)
    if mirror_base and dates:
        files.make_dir(spark, mirror_base)
        recover(spark, mirror_base)
        copy = f"{mirror_base}/_run-{uuid.uuid4().hex}"
        for part, kind, order in (("", schema, "ts"), (f"/{HOURS}", ddl(HOURS_TYPES), "hour"))[:1 + hours]:
            written = spark.read.schema(kind).option("basePath", base + part).parquet(*[f"{base}{part}/{d}" for d in dates])
            write_partitions(written, copy + part, order)
        exchange(spark, copy, mirror_base, folders)
    # A plan that is empty from the start counts nothing.
    return Run([d.removeprefix("date=") for d in dates], watch.get if dates else dict.fromkeys(totals, 0))


def archive_events(changes: DataFrame, base: str, tz: str = DEFAULT_TZ,
                   first_day: date | str | None = None, last_day: date | str | None = None,
                   mirror_base: str | None = None, partitioned: bool = False) -> Run:
    """Archive the log, or only the days asked for; the mirror gets the dates of this run.

    `partitioned`: the log is partitioned by publish date in `tz`, so other days are not read. The
    totals are events, taken and returned.
    """
    if first_day is not None:
        changes = read_log_days(changes, first_day, last_day, tz, partitioned)
    delta = F.col("bikes_delta").cast("int")
    totals = {"events": F.count("*"), "taken": F.coalesce(F.sum(taken(delta)), F.lit(0)),
              "returned": F.coalesce(F.sum(returned(delta)), F.lit(0))}
    return _write(event_rows(changes, tz), base, ddl(ARCHIVE_EVENT_TYPES), mirror_base, totals, True)


def archive_weather(hours: DataFrame, base: str, first_day: date | str | None = None,
                    last_day: date | str | None = None, mirror_base: str | None = None) -> Run:
    """Archive hourly weather, or only the days asked for. The totals are rain, lowest and highest temperature of each of those days."""
    totals = {"hours": F.count("*")}
    if first_day is not None:
        first, last = (date.fromisoformat(str(d)) for d in (first_day, last_day or first_day))
        hours = hours.where(F.col("date").between(F.lit(first), F.lit(last)))
        for n in range((last - first).days + 1):
            day = first + timedelta(days=n)
            own = F.col("date") == F.lit(day)
            totals |= {f"{day} rain": F.round(F.sum(F.when(own, F.col("precipitation"))), 6),
                       f"{day} lowest": F.min(F.when(own, F.col("temperature"))), f"{day} highest": F.max(F.when(own, F.col("temperature")))}
    rows = hours.select(
        *[F.col(c).cast(kind).alias(c) for c, kind in ARCHIVE_WEATHER_TYPES.items()], "date")
    return _write(rows, base, ddl(ARCHIVE_WEATHER_TYPES), mirror_base, totals, False)


def weather_totals(run: Run) -> list[tuple[str, float, float, float]]:
    """date, rain, lowest and highest temperature of a weather run's days that have any."""
    of = lambda day: tuple(run.totals[f"{day} {what}"] for what in ("rain", "lowest", "highest"))
    return [(day, *of(day)) for day in run.dates]


def _read(spark: SparkSession, base: str, part: str, schema: str) -> DataFrame:
    recover(spark, base)
    return read_or_empty(spark, base + part, schema)


def read_event_archive(spark: SparkSession, base: str) -> DataFrame:
    return _read(spark, base, "", ddl(ARCHIVE_EVENT_TYPES))


def read_hour_sums(spark: SparkSession, base: str) -> DataFrame:
    """The event archive's sums per date and hour."""
    return _read(spark, base, f"/{HOURS}", ddl(HOURS_TYPES))


def read_weather_archive(spark: SparkSession, base: str) -> DataFrame:
    return _read(spark, base, "", ddl(ARCHIVE_WEATHER_TYPES))
