"""Indicators of the moment, of the day, and against the archives."""

from pyspark.sql import DataFrame, functions as F

from dockflow.functions import numbers, station
from dockflow.functions.clock import DEFAULT_TZ, bucket, local_hour, local_hour_fraction

MIN_SHARE = 0.05  # below this elapsed share a projection is not given
RATE_MINUTES = 15


def _total(column):
    return F.coalesce(F.sum(column), F.lit(0))


def header_stats(latest: DataFrame) -> DataFrame:
    """Network totals; empty counts open stations only, full does not ask for renting."""
    return latest.agg(
        _total("bikes_available").alias("bikes"), _total("mechanical").alias("mechanical"),
        _total("ebike").alias("ebike"), _total("docks_available").alias("docks"),
        F.count_if(station.is_empty()).alias("empty"),
        F.count_if(station.is_full()).alias("full"),
        F.count_if(~station.is_open()).alias("closed"))


def kpi_instant(latest: DataFrame) -> DataFrame:
    """Ratios over the open stations; here only open stations count as full."""
    is_open = station.is_open()
    opened = lambda column: _total(F.when(is_open, F.col(column)))
    sums = latest.agg(
        F.count("*").alias("total"),
        F.count_if(is_open).alias("open"),
        opened("bikes_available").alias("bikes"), opened("mechanical").alias("mechanical"),
        opened("ebike").alias("ebike"), opened("capacity").alias("capacity"),
        F.count_if(is_open & (F.col("bikes_available") > 0)).alias("with_bike"),
        F.count_if(is_open & ~(F.col("bikes_available") > 0)).alias("empty"),
        F.count_if(is_open & station.is_full()).alias("full"))
    dash = lambda part, whole: F.when(
        F.col(whole) != 0, numbers.percent_label(F.col(part) / F.col(whole))).otherwise(F.lit("–"))
    fill = numbers.ratio(F.col("bikes"), F.col("capacity"), 0.0)
    electric = numbers.ratio(F.col("ebike"), F.col("ebike") + F.col("mechanical"), 0.0)
    return sums.select(
        "*", numbers.percent_label(fill).alias("fill"),
        numbers.percent_label(electric).alias("electric"),
        dash("with_bike", "open").alias("availability"),
        (F.col("empty") + F.col("full")).alias("tension"),
        dash("open", "total").alias("open_share"))


def kpi_day(minutes: DataFrame, now: int) -> DataFrame:
    """Movements and events of the day, net flow, and the rate of the last 15 minutes."""
    end = now // 60 * 60
    recent = (F.col("t") > end - RATE_MINUTES * 60) & (F.col("t") <= end)
    moves = F.col("taken") + F.col("returned")
    sums = minutes.agg(
        _total("events").alias("events"), _total("taken").alias("taken"),
        _total("returned").alias("returned"), _total(F.when(recent, moves)).alias("last_15_min"))
    net = F.col("returned") - F.col("taken")
    return sums.select(
        "events", "taken", "returned", (F.col("taken") + F.col("returned")).alias("rotations"),
        net.alias("net"), numbers.signed_label(net).alias("net_label"), "last_15_min",
        numbers.fixed(F.col("last_15_min") / RATE_MINUTES, 1).alias("rate"))


def kpi_peak_hour(minutes: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """The hour with most movements, the earliest of equals; null without movement."""
    hourly = minutes.groupBy(bucket(F.col("t"), 3600).alias("h")).agg(
        F.sum(F.col("taken") + F.col("returned")).alias("moves")).where("moves > 0")
    peak = hourly.agg(F.max(F.struct("moves", (-F.col("h")).alias("neg"))).alias("p"))
    hour = -F.col("p.neg")
    return peak.select(
        hour.alias("t"), F.concat(local_hour(hour, tz).cast("string"), F.lit(" h")).alias("hour"),
        F.coalesce(F.col("p.moves"), F.lit(0)).alias("moves"))


def today_vs_average(minutes: DataFrame, daily: DataFrame) -> DataFrame:
    """Movements today against the mean archived day; dash without archives.

    Both sides are folded into one global aggregate instead of a cross join.
    """
    moves = F.col("taken") + F.col("returned")
    today = minutes.select(moves.alias("today"), F.lit(None).cast("bigint").alias("past"))
    past = daily.select(F.lit(0).cast("bigint").alias("today"), moves.alias("past"))
    sums = today.unionByName(past).agg(
        _total("today").alias("rotations"), F.count("past").alias("days"),
        F.avg("past").alias("mean"))
    return sums.select(
        "rotations", "days", numbers.half_up(F.col("mean")).alias("average"),
        F.when(F.coalesce(F.col("mean"), F.lit(0.0)) != 0, numbers.percent_label(
            F.col("rotations") / F.col("mean"))).otherwise(F.lit("–")).alias("vs_average"))


def day_projection(profile: DataFrame, flows: DataFrame, now: int,
                   tz: str = DEFAULT_TZ) -> DataFrame:
    """Bikes taken by the end of the day, from the elapsed part of the mean profile.

    The current hour counts pro rata, and only hours in the profile count.
    """
    clock = F.lit(local_hour_fraction(now, tz))
    hour, taken = F.col("hour").cast("double"), F.col("taken")
    done = F.when(hour + 1 <= clock, taken).when(hour < clock, taken * (clock - hour)).otherwise(0.0)
    past = profile.select(F.lit(0).cast("bigint").alias("today"), taken.alias("whole"),
                          done.cast("double").alias("done"))
    today = flows.select(taken.alias("today"), F.lit(0).cast("bigint").alias("whole"),
                         F.lit(0.0).alias("done"))
    sums = past.unionByName(today).agg(
        _total("today").alias("today_taken"), _total("whole").alias("whole"),
        F.round(F.coalesce(F.sum("done"), F.lit(0.0)), 6).alias("done"))
    share = numbers.ratio(F.col("done"), F.col("whole"), 0.0)
    known = share > MIN_SHARE
    return sums.select(
        "today_taken", F.round(share, 6).alias("share"),
        F.when(known, numbers.half_up(F.col("today_taken") / share)).alias("projected"),
        F.when(known, numbers.percent_label(share)).otherwise(F.lit("–")).alias("share_label"))
