"""Aggregates per district and per map cluster."""

from pyspark.sql import DataFrame, Window, functions as F

from dockflow.functions import numbers, station
from dockflow.sources.documents import district_rings

UNITS = 10_000_000  # per degree, about 1 cm


def _centre(column: str):
    """Mean coordinate, from whole units so that it does not depend on task order."""
    units = F.round(F.col(column) * F.lit(float(UNITS))).cast("bigint")
    return (F.sum(units) / F.count("*") / F.lit(float(UNITS))).alias(column)


def districts(snap: DataFrame) -> DataFrame:
    """State, flows and centroid per district 1 to 20, in their order; suburbs are left out."""
    rows = snap.withColumn("arr", station.district(F.col("station_code"))).where(
        F.col("arr").isNotNull())
    return rows.groupBy("arr").agg(
        F.count("*").alias("stations"),
        F.sum("bikes_available").alias("bikes"),
        F.sum("ebike").alias("ebike"),
        F.sum("capacity").alias("capacity"),
        F.sum("docks_available").alias("docks"),
        F.count_if(station.is_empty()).alias("empty"),
        F.count_if(station.is_full()).alias("full"),
        F.sum("taken").alias("taken"),
        F.sum("returned").alias("returned"),
        _centre("lat"), _centre("lon"),
    ).orderBy("arr")


def heat(by_district: DataFrame) -> DataFrame:
    """Activity scaled to 0..1 over the districts (at most 20 rows, one window)."""
    everything = Window.partitionBy()
    moves = F.col("taken") + F.col("returned")
    low = F.min(moves).over(everything)
    high = F.greatest(F.max(moves).over(everything), low + 1)
    return by_district.select("arr", moves.alias("moves"),
                              ((moves - low) / (high - low)).alias("heat"), "lat", "lon")


def district_map(features: DataFrame, by_district: DataFrame) -> DataFrame:
    """Every district shape with its heat and label place, null without stations."""
    shapes = district_rings(features).groupBy("arr").agg(F.count("*").alias("rings"))
    return shapes.join(heat(by_district), "arr", "left").select(
        "arr", "rings", "moves", "heat", "lat", "lon")


def city_overview(by_district: DataFrame) -> DataFrame:
    """Totals over the districts and the mean fill in whole percent."""
    sums = by_district.agg(
        F.count("*").alias("districts"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (
            "stations", "bikes", "ebike", "capacity", "empty", "taken", "returned")])
    return sums.withColumn("moves", F.col("taken") + F.col("returned")).withColumn(
        "fill", F.when(F.col("capacity") != 0, numbers.half_up(
            F.lit(100) * F.col("bikes") / F.col("capacity"))))


def district_detail(by_district: DataFrame, arr: int) -> DataFrame:
    """One district with its fill in whole percent, 0 without capacity."""
    fill = F.when(F.col("capacity") != 0, numbers.half_up(
        F.lit(100) * F.col("bikes") / F.col("capacity"))).otherwise(F.lit(0))
    return by_district.where(F.col("arr") == arr).select(
        "arr", "stations", "bikes", "ebike", "docks", fill.alias("fill"), "empty", "full",
        (F.col("taken") + F.col("returned")).alias("moves"), "taken", "returned")


def map_clusters(latest: DataFrame, mode: str = "bikes") -> DataFrame:
    """Bubbles of the far map: per district in town, per grid cell elsewhere."""
    arr = station.district(F.col("station_code"))
    cell = F.concat_ws("_", station.grid_cell(F.col("lat")).cast("string"),
                       station.grid_cell(F.col("lon")).cast("string"))
    rows = latest.withColumn("arr", arr).withColumn(
        "cell", F.when(F.col("arr").isNull(), cell))
    grouped = rows.groupBy("arr", "cell").agg(
        F.count("*").alias("n"),
        F.sum("bikes_available").alias("bikes"),
        F.sum("docks_available").alias("docks"),
        F.sum("capacity").alias("capacity"),
        _centre("lat"), _centre("lon"),
    )
    counted = F.col("bikes" if station.check_mode(mode) == "bikes" else "docks")
    in_town = F.col("arr").isNotNull()
    return grouped.select(
        F.coalesce(F.col("arr").cast("string"), F.col("cell")).alias("cluster"),
        in_town.alias("in_town"), "n", "bikes", "docks", "capacity", "lat", "lon",
        numbers.ratio(counted, F.col("capacity"), 0.0).alias("ratio"),
        F.when(in_town, station.fill_level(counted, F.col("capacity"), 0.0)).otherwise(
            F.lit("closed")).alias("level"))
