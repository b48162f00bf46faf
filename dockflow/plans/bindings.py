"""The driver tables seen as source documents (formulas in FIXTURES.md, section 7).

Everything here is a projection of `supplier` or `events`; one document is made
per row, so that no step gathers a table in one place.
"""

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dockflow import schemas
from dockflow.functions.clock import epoch_seconds
from dockflow.functions.station import district

# Parameters of the reference moment (fixed values).
DAY = "2024-01-30"  # the last whole local day of the data
NOW = 1706654700  # 23:45 in Paris
PRICE = 1.00
SEARCH = "republique"
DISTRICT = 16

EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                 "value double, props string")
SUPPLIER_SCHEMA = "s_suppkey bigint, s_nationkey int"


def table(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(os.path.join(sf_dir, f"{name}.parquet"))


def supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier", SUPPLIER_SCHEMA)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the integers the formulas use: epoch `ts`, `k`, `v`."""
    raw = table(spark, sf_dir, "events", EVENTS_SCHEMA)
    return raw.select(
        "event_id", "user_id", "event_type", epoch_seconds(F.col("ts")).alias("ts"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.floor(F.col("value") / 20).cast("int").alias("v"))


def information_documents(suppliers: DataFrame) -> DataFrame:
    """Information documents; each lists an outdated entry before the valid one."""
    s, n = F.col("s_suppkey"), F.col("s_nationkey")

    def unless(condition: Column, value: Column) -> Column:
        return F.when(~condition, value)

    code = F.format_string("%05d", (n + 1) * 1000 + s % 1000)
    name = (F.when(s % 3 == 0, F.lit("Place République "))
            .when(s % 3 == 1, F.lit("Gare Élysée ")).otherwise(F.lit("Rue Sainte-Anne ")))
    place = [s.alias("station_id")], [
        ((F.lit(48800) + (s * 37) % 100) / 1000).alias("lat"),
        ((F.lit(2250) + (s * 53) % 170) / 1000).alias("lon")]

    def station(code: Column, name: Column, capacity: Column) -> Column:
        return F.struct(*place[0], code.alias("stationCode"), name.alias("name"), *place[1],
                        capacity.cast("int").alias("capacity"))

    outdated = station(F.lit("99999"), F.lit("?"), F.lit(1))
    valid = station(
        unless(s % 43 == 9, F.when(s % 37 == 5, F.lit("N/A")).otherwise(code)),
        unless(s % 41 == 7, F.concat(name, s.cast("string"))),
        unless(s % 29 == 3, 4 + s % 5))
    return suppliers.select(F.struct(F.array(outdated, valid).alias("stations")).alias("data"))


def status_rows(facts: DataFrame) -> DataFrame:
    """Status entries, one per event, with the record metadata beside them."""
    k, v, ts, kind = (F.col(c) for c in ("k", "v", "ts", "event_type"))
    electric = F.floor(v / 3).cast("int")
    off = lambda condition: F.when(condition, 0).otherwise(1)
    return facts.select(
        F.col("user_id").alias("station_id"),
        "ts",
        F.when(k != 3, v).alias("num_bikes_available"),
        F.array(F.create_map(F.lit("mechanical"), v - electric),
                F.create_map(F.lit("ebike"), electric)).alias("num_bikes_available_types"),
        F.when(k != 7, F.greatest(6 - v, F.lit(0))).alias("num_docks_available"),
        off((kind == "error") & (k < 50)).alias("is_installed"),
        off(kind == "error").alias("is_renting"),
        off(kind.isin("error", "signup") & (k >= 20)).alias("is_returning"),
        F.when(k != 11, ts - k).alias("last_reported"),
        F.col("event_id").alias("offset"),
        (ts + k % 90).alias("publish_ts"),
    )


def status_documents(facts: DataFrame) -> DataFrame:
    """The same entries as nested documents, each holding one of them."""
    fields = schemas.STATUS_SCHEMA["data"].dataType["stations"].dataType.elementType.fieldNames()
    return status_rows(facts).select(
        F.col("ts").alias("lastUpdatedOther"),
        F.struct(F.array(F.struct(*fields)).alias("stations")).alias("data"),
        "offset", "publish_ts")


def weather_documents(facts: DataFrame) -> DataFrame:
    """One document per UTC day with parallel hourly arrays (at most 24 entries)."""
    hour = F.floor(F.col("ts") / 3600) * 3600
    hourly = facts.groupBy(hour.alias("h")).agg(
        F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"),
        F.sum("k").alias("k_sum"), F.min("k").alias("k_min"))
    iso = F.format_string(
        "%sT%02d:00", F.date_add(F.lit("1970-01-01").cast("date"),
                                 F.floor(F.col("h") / 86400).cast("int")).cast("string"),
        F.floor(F.pmod("h", F.lit(86400)) / 3600))
    entry = F.struct(
        iso.alias("time"), (F.col("errors") / 10).alias("precipitation"),
        (F.col("k_sum") % 300 / 10).alias("temperature_2m"),
        (F.col("n") * F.lit(1.5)).alias("wind_speed_10m"),
        (F.col("k_sum") % 101).cast("int").alias("relative_humidity_2m"),
        F.col("k_min").alias("weather_code"))
    days = hourly.groupBy(F.floor(F.col("h") / 86400).alias("day")).agg(
        F.array_sort(F.collect_list(entry)).alias("hours"))
    fields = ["time", "precipitation", "temperature_2m", "wind_speed_10m",
              "relative_humidity_2m", "weather_code"]
    return days.select(F.struct(*[F.col(f"hours.{f}").alias(f) for f in fields]).alias("hourly"))


def district_features(info: DataFrame) -> DataFrame:
    """One rectangle per district around its stations; even ids as MultiPolygon."""
    boxes = (info.withColumn("arr", district(F.col("station_code")))
             .where(F.col("arr").isNotNull()).groupBy("arr").agg(
        F.min("lon").alias("w"), F.max("lon").alias("e"),
        F.min("lat").alias("s"), F.max("lat").alias("n")))
    corners = [("w", "s"), ("e", "s"), ("e", "n"), ("w", "n"), ("w", "s")]
    ring = F.array(*[F.array(lon, lat) for lon, lat in corners])
    single = F.to_json(F.struct(F.array(ring).alias("c")))
    multi = F.to_json(F.struct(F.array(F.array(ring)).alias("c")))
    even = F.col("arr") % 2 == 0
    return boxes.select(
        F.struct("arr").alias("properties"),
        F.struct(
            F.when(even, F.lit("MultiPolygon")).otherwise(F.lit("Polygon")).alias("type"),
            F.get_json_object(F.when(even, multi).otherwise(single), "$.c").alias("coordinates"),
        ).alias("geometry"))


def damaged_log(log: DataFrame) -> DataFrame:
    """The log with records of each broken kind mixed in, by offset."""
    value, slot = F.col("value"), F.col("offset") % 20
    broken = (
        F.when(slot == 1, F.lit('{"broken": '))
        .when(slot == 4, F.concat(F.lit("["), value, F.lit("]")))
        .when(slot == 7, F.lit('{"shape": "unknown"}'))
        .when(slot == 10, F.regexp_replace(value, ',"bikes_delta":[-0-9]+', ""))
        .when(slot == 13, F.regexp_replace(value, "}$", ',"extra":1}'))
        .when(slot == 16, F.regexp_replace(value, '"capacity":[0-9]+', '"capacity":null'))
        .otherwise(value))
    return log.withColumn("value", broken)
