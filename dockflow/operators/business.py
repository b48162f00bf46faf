"""Operator view: snapshot with today's flows, totals and action lists."""

from pyspark.sql import DataFrame, functions as F

from dockflow.functions import numbers, station

LIST_FIELDS = ["station_id", "name", "net", "taken", "returned", "lat", "lon"]


def snapshot(latest: DataFrame, flows: DataFrame) -> DataFrame:
    """Latest state with today's flows, 0 where a station did not move."""
    return latest.join(flows, "station_id", "left").withColumns({
        "taken": F.coalesce("taken", F.lit(0)),
        "returned": F.coalesce("returned", F.lit(0)),
    })


def _moves():
    return F.col("taken") + F.col("returned")


def _net():
    return F.col("returned") - F.col("taken")


def business_totals(latest: DataFrame, flows: DataFrame) -> DataFrame:
    """Totals over all flows; risk and bikes to move over stations with a state."""
    rows = latest.withColumn("known", F.lit(True)).join(flows, "station_id", "full").withColumns({
        "known": F.coalesce("known", F.lit(False)),
        "taken": F.coalesce("taken", F.lit(0)),
        "returned": F.coalesce("returned", F.lit(0)),
    })
    risky = F.col("known") & (station.is_out_of_order() | station.is_empty() | station.is_full())
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return rows.agg(
        total("taken").alias("today_taken"),
        total("returned").alias("today_returned"),
        total(_moves()).alias("total_moves"),
        total(F.when(risky, _moves())).alias("at_risk_moves"),
        F.floor(total(F.when(F.col("known"), F.abs(_net()))) / 2).cast("bigint").alias("to_move"),
    ).withColumn(
        "at_risk_share",
        F.when(F.col("total_moves") != 0, numbers.percent_label(
            F.col("at_risk_moves") / F.col("total_moves"))).otherwise(F.lit("–")))


def business_rebalance(latest: DataFrame, flows: DataFrame, n: int = 12) -> DataFrame:
    """Empty or full stations, those that carry most movements first."""
    rows = snapshot(latest, flows).where(station.is_empty() | station.is_full())
    state = F.when(station.is_empty(), F.lit(station.STATE_EMPTY)).otherwise(
        F.lit(station.STATE_FULL))
    return rows.select(
        "station_id", "name", "lat", "lon", state.alias("state"), _moves().alias("moves"),
        "capacity", F.col("bikes_available").alias("bikes"), F.col("docks_available").alias("docks"),
    ).orderBy(F.desc("moves"), "station_id").limit(n)


def _nets(latest: DataFrame, flows: DataFrame) -> DataFrame:
    return snapshot(latest, flows).withColumn("net", _net()).select(*LIST_FIELDS)


def business_sinks(latest: DataFrame, flows: DataFrame, n: int = 8) -> DataFrame:
    """Where bikes gather: highest positive net flow."""
    return _nets(latest, flows).where("net > 0").orderBy(F.desc("net"), "station_id").limit(n)


def business_sources(latest: DataFrame, flows: DataFrame, n: int = 8) -> DataFrame:
    """Where bikes leave from: lowest negative net flow."""
    return _nets(latest, flows).where("net < 0").orderBy("net", "station_id").limit(n)


def business_revenue(latest: DataFrame, flows: DataFrame, price: float) -> DataFrame:
    """Revenue estimate and trips per bike; the latter is a dash without bikes."""
    taken = flows.select("taken", F.lit(0).alias("bikes"))
    bikes = latest.select(F.lit(0).cast("bigint").alias("taken"),
                          F.col("bikes_available").alias("bikes"))
    totals = taken.unionByName(bikes).agg(
        F.coalesce(F.sum("taken"), F.lit(0)).alias("today_taken"),
        F.coalesce(F.sum("bikes"), F.lit(0)).alias("fleet"))
    per_bike = F.when(F.col("fleet") != 0, numbers.fixed(
        F.col("today_taken") / F.col("fleet"), 2)).otherwise(F.lit("–"))
    return totals.select(
        "today_taken", "fleet",
        numbers.half_up(F.col("today_taken") * F.lit(float(price))).alias("revenue"),
        per_bike.alias("trips_per_bike"))


def most_active(snap: DataFrame, n: int = 5, district: int | None = None,
                least: bool = False) -> DataFrame:
    """Most (or least) active stations, of one district if asked."""
    rows = _of_district(snap, district).select("station_id", "name", _moves().alias("moves"))
    order = F.asc("moves") if least else F.desc("moves")
    return rows.orderBy(order, "station_id").limit(n)


def fullest(snap: DataFrame, n: int = 3, district: int | None = None,
            emptiest: bool = False) -> DataFrame:
    """Fullest (or emptiest) stations by bikes per capacity."""
    fill = F.col("bikes_available") / F.col("capacity")
    rows = _of_district(snap, district).where("capacity > 0").withColumn("fill", fill)
    order = F.asc("fill") if emptiest else F.desc("fill")
    return rows.orderBy(order, "station_id").limit(n).select(
        "station_id", "name", numbers.half_up(F.col("fill") * 100).alias("percent"))


def _of_district(snap: DataFrame, district: int | None) -> DataFrame:
    if district is None:
        return snap
    return snap.where(station.district(F.col("station_code")) == district)
