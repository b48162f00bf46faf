"""Activity of the current day: minute buckets, series, station flows."""

from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from dockflow.functions.clock import DEFAULT_TZ, bucket, day_bounds
from dockflow.functions.station import display_name, returned, taken

BASE_STEP = 60
STEPS = (60, 300, 900, 3600)
DEFAULT_STEP = 300
COUNTS = ("events", "taken", "returned")


def valid_step(step: int) -> int:
    return step if step in STEPS else DEFAULT_STEP


def of_day(changes: DataFrame, day: date | str, tz: str = DEFAULT_TZ) -> DataFrame:
    """Events whose own time lies in the local calendar day."""
    start, end = day_bounds(day, tz)
    return changes.where((F.col("ts") >= start) & (F.col("ts") < end))


def minute_counts(changes: DataFrame, step: int = BASE_STEP) -> DataFrame:
    """Events, bikes taken and bikes returned per bucket."""
    delta = F.col("bikes_delta")
    return changes.groupBy(bucket(F.col("ts"), step).alias("t")).agg(
        F.count("*").alias("events"), F.sum(taken(delta)).alias("taken"),
        F.sum(returned(delta)).alias("returned"))


def activity_minutes(changes: DataFrame, day: date | str, tz: str = DEFAULT_TZ) -> DataFrame:
    return minute_counts(of_day(changes, day, tz))


def station_flows(changes: DataFrame, day: date | str, tz: str = DEFAULT_TZ) -> DataFrame:
    """Bikes taken and returned per station; stations without movement are absent."""
    delta = F.col("bikes_delta")
    moved = of_day(changes, day, tz).where(delta != 0)
    return moved.groupBy("station_id").agg(
        F.sum(taken(delta)).alias("taken"), F.sum(returned(delta)).alias("returned"))


def activity_series(minutes: DataFrame, step: int, since: int, until: int) -> DataFrame:
    """Continuous series in time order from `since` (floored to the step) to `until`, both included.

    Buckets are tested by their minute start; missing points are 0.
    """
    step = valid_step(step)
    since = since // step * step
    points = minutes.where(F.col("t").between(since, until)).groupBy(
        bucket(F.col("t"), step).alias("t")).agg(*[F.sum(c).alias(c) for c in COUNTS])
    spine = minutes.sparkSession.range(since, until + 1, step, 1).toDF("t")
    return spine.join(points, "t", "left").select(
        "t", *[F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS]).orderBy("t")


def trimmed(series: DataFrame) -> DataFrame:
    """The series without its leading and trailing points of no movement.

    The window is unpartitioned, over at most one day of points.
    """
    everything = Window.partitionBy()
    moving = F.when((F.col("taken") != 0) | (F.col("returned") != 0), F.col("t"))
    marked = series.withColumn("first", F.min(moving).over(everything)).withColumn(
        "last", F.max(moving).over(everything))
    inside = marked.where(F.col("t").between(F.col("first"), F.col("last")))
    return inside.drop("first", "last").orderBy("t")


def sparkline(minutes: DataFrame, now: int) -> DataFrame:
    """Movements of the last 60 minutes, one point each, ending at the current one."""
    end = now // 60 * 60
    points = activity_series(minutes, 60, end - 59 * 60, end)
    return points.select("t", (F.col("taken") + F.col("returned")).alias("moves")).orderBy("t")


def top_stations(flows: DataFrame, n: int = 8) -> DataFrame:
    moves = (F.col("taken") + F.col("returned")).alias("moves")
    return flows.select("station_id", moves).orderBy(F.desc("moves"), "station_id").limit(n)


def activity_top(flows: DataFrame, latest: DataFrame, n: int = 8) -> DataFrame:
    """Top stations in order, with their names, or the id where there is no name.

    The `n` ids at most are broadcast to pick their names.
    """
    top = top_stations(flows, n)
    names = latest.select("station_id", "name").join(
        F.broadcast(top.select("station_id")), "station_id", "left_semi")
    return top.join(names, "station_id", "left").select(
        "station_id", display_name(F.col("name"), F.col("station_id")).alias("name"), "moves",
    ).orderBy(F.desc("moves"), "station_id")
