"""Status entries joined with station information."""

from pyspark.sql import DataFrame, functions as F

from dockflow.functions.station import bike_types, flag
from dockflow.schemas import EVENT_FIELDS, RECORD_FIELDS


def counters(status: DataFrame) -> DataFrame:
    """The moving part of a state: counts, flags and times, with the null rules applied."""
    typed = status.withColumn("types", bike_types(F.col("num_bikes_available_types")))
    mechanical, ebike = F.col("types.mechanical"), F.col("types.ebike")
    return typed.select(
        "station_id",
        "ts",
        F.coalesce(F.nullif("last_reported", F.lit(0)), F.col("ts")).alias("last_reported"),
        mechanical.alias("mechanical"),
        ebike.alias("ebike"),
        F.coalesce("num_bikes_available", mechanical + ebike).alias("bikes_available"),
        F.coalesce("num_docks_available", F.lit(0)).alias("docks_available"),
        *[flag(F.col(c)).alias(c) for c in ("is_installed", "is_renting", "is_returning")],
        *RECORD_FIELDS,
    )


def describe(states: DataFrame, info: DataFrame) -> DataFrame:
    """Add the fixed context of a station; rows without information are dropped.

    No broadcast hint: Spark broadcasts the information while its measured size
    allows, and beyond that AQE splits a station that dominates the rows.
    """
    joined = states.join(info, "station_id")
    fields = [f for f in EVENT_FIELDS if f in joined.columns]
    return joined.select(*fields, *RECORD_FIELDS)


def readings(status: DataFrame, info: DataFrame) -> DataFrame:
    """Full state of a station at each reading."""
    return describe(counters(status), info)


def feed_summary(info: DataFrame, states: DataFrame) -> DataFrame:
    """Stations known, states joined, bikes, and empty renting stations."""
    known = info.select(F.lit(1).alias("info"), F.lit(0).alias("joined"),
                        F.lit(0).alias("bikes"), F.lit(0).alias("empty"))
    seen = states.select(
        F.lit(0).alias("info"), F.lit(1).alias("joined"), F.col("bikes_available").alias("bikes"),
        ((F.col("bikes_available") == 0) & F.col("is_renting")).cast("int").alias("empty"))
    return known.unionByName(seen).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("info", "joined", "bikes", "empty")])
