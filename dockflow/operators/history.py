"""Queries over the archives. `date` is the partition column; events are read as their sums per date and hour."""

from pyspark.sql import DataFrame, functions as F


def history_daily(hours: DataFrame) -> DataFrame:
    """Events, bikes taken and returned per archived date, in date order."""
    days = hours.groupBy("date").agg(*[F.sum(c).alias(c) for c in ("events", "taken", "returned")])
    return days.orderBy("date").withColumn("date", F.col("date").cast("string"))


def history_profile(hours: DataFrame) -> DataFrame:
    """Mean taken and returned per local hour over the dates with movement in it.

    Means are rounded half to even.
    """
    moving = hours.where((F.col("taken") > 0) | (F.col("returned") > 0))
    mean = lambda c: F.bround(F.avg(c), 0).cast("bigint").alias(c)
    return moving.groupBy("hour").agg(mean("taken"), mean("returned")).orderBy("hour")


def archive_summary(hours: DataFrame) -> DataFrame:
    """Events, bikes taken and returned over the archived dates given."""
    return hours.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("events", "taken", "returned")])


def weather_daily(weather: DataFrame) -> DataFrame:
    """Rain and temperature range per date; rain is rounded to 6 places."""
    return weather.groupBy("date").agg(
        F.round(F.sum("precipitation"), 6).alias("rain"),
        F.min("temperature").alias("temperature_min"),
        F.max("temperature").alias("temperature_max"),
    ).withColumn("date", F.col("date").cast("string"))
