"""The registered queries: names bound to operators over the driver tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from dockflow import schemas
from dockflow.functions import numbers, station
from dockflow.functions.clock import clock_label, day_bounds, day_label, local_date, local_hour
from dockflow.operators import activity, business, districts, history, indicators, search, state
from dockflow.operators.readings import feed_summary
from dockflow.plans import bindings
from dockflow.plans.derived import Derived
from dockflow.plans.streams import STREAMS
from dockflow.session import new_dir
from dockflow.sources import archive, documents, log

BACKFILL_DAYS = ("2024-01-10", "2024-01-15")  # the range asked for

Plan = Callable[[Derived], DataFrame]


def _text(docs: DataFrame) -> DataFrame:
    """Documents as JSON text, as a file or a request delivers them."""
    keep = [c for c in schemas.RECORD_FIELDS if c in docs.columns]
    return docs.select(F.to_json(F.struct(*[c for c in docs.columns if c not in keep])).alias("value"),
                       *keep)


def _status(d: Derived) -> DataFrame:
    docs = _text(bindings.status_documents(d.facts()))
    return documents.status_scan(documents.parse_documents(docs, schemas.STATUS_SCHEMA))


def _info_scan(d: Derived) -> DataFrame:
    docs = _text(bindings.information_documents(bindings.supplier(d.spark, d.sf_dir)))
    return documents.station_info(documents.parse_documents(docs, schemas.INFORMATION_SCHEMA))


def _weather_hourly(d: Derived) -> DataFrame:
    docs = _text(bindings.weather_documents(d.facts()))
    parsed = documents.parse_documents(docs, schemas.WEATHER_DOCUMENT_SCHEMA)
    return documents.weather_hourly(parsed, d.tz)


def _bike_types(d: Derived) -> DataFrame:
    return _status(d).select("offset", station.bike_types(
        F.col("num_bikes_available_types")).alias("t")).select("offset", "t.*")


def _archive_events(d: Derived) -> DataFrame:
    base = new_dir(d.spark, "archive-events")
    archive.archive_events(d.changes(), base, d.tz)
    return archive.read_event_archive(d.spark, base)


def _archive_run(d: Derived) -> DataFrame:
    """Totals that an archive run counted while it wrote, with its number of dates."""
    run = archive.archive_events(d.changes(), new_dir(d.spark, "archive-run"), d.tz)
    return d.spark.createDataFrame([(len(run.dates), *(run.totals[c] for c in ("events", "taken", "returned")))],
                                   "dates bigint, events bigint, taken bigint, returned bigint")


def _archive_repeats(d: Derived) -> DataFrame:
    """The archive of a log that holds each record twice."""
    records = log.encode_log(d.changes())
    events, _ = log.decode_log(records.unionByName(records))
    base = new_dir(d.spark, "archive-repeats")
    archive.archive_events(log.drop_repeats(events), base, d.tz)
    return archive.read_event_archive(d.spark, base)


def _archive_weather(d: Derived) -> DataFrame:
    base = new_dir(d.spark, "archive-weather")
    archive.archive_weather(d.weather(), base)
    return archive.read_weather_archive(d.spark, base)


def _weather_daily(d: Derived) -> DataFrame:
    return history.weather_daily(d.weather())


def _archive_mirror(d: Derived) -> DataFrame:
    base, mirror = new_dir(d.spark, "archive"), new_dir(d.spark, "mirror")
    archive.archive_events(d.changes(), base, d.tz, mirror_base=mirror)
    return archive.read_event_archive(d.spark, mirror)


def _archive_backfill(d: Derived) -> DataFrame:
    base = new_dir(d.spark, "backfill")
    archive.archive_events(d.changes(), base, d.tz, *BACKFILL_DAYS, partitioned=True)
    return archive.read_event_archive(d.spark, base)


def _log_day_read(d: Derived) -> DataFrame:
    return log.read_log_days(d.changes(), d.day, tz=d.tz, partitioned=True).drop("date")


def _damaged(d: Derived) -> DataFrame:
    return bindings.damaged_log(log.encode_log(d.changes()))


def _series(step: int) -> Plan:
    return lambda d: activity.activity_series(d.minutes(), step, day_bounds(d.day, d.tz)[0], d.now)


def _age(d: Derived) -> DataFrame:
    reported = F.coalesce(F.nullif("last_reported", F.lit(0)), F.col("ts"))
    return d.changes().select("offset", (F.lit(d.now) - reported).alias("age")).withColumn(
        "label", numbers.age_label(F.col("age")))


PLANS: dict[str, Plan] = {
    # sources and sinks
    "info_scan": _info_scan,
    "status_scan": lambda d: _status(d).drop("num_bikes_available_types"),
    "bike_types": _bike_types,
    "weather_hourly": _weather_hourly,
    "archive_weather": _archive_weather,
    "weather_daily": _weather_daily,
    "log_encode": lambda d: log.encode_log(d.changes()),
    "log_roundtrip": lambda d: log.decode_log(log.encode_log(d.changes()))[0],
    "log_day_read": _log_day_read,
    "poison_good": lambda d: log.decode_log(_damaged(d))[0],
    "poison_rejected": lambda d: log.decode_log(_damaged(d))[1],
    "archive_events": _archive_events,
    "archive_mirror": _archive_mirror,
    "archive_run": _archive_run,
    "archive_repeats": _archive_repeats,
    "archive_backfill": _archive_backfill,
    "monitor_line": lambda d: log.monitor_line(d.changes()),
    "geo_bbox": lambda d: documents.geo_bbox(d.features()),
    # readings, changes, state
    "readings": lambda d: d.readings(),
    "feed_summary": lambda d: feed_summary(d.info(), d.readings()),
    "detect_changes": lambda d: d.detected(),
    "latest_state": lambda d: state.latest_state(d.changes()),
    "snapshot_retype": lambda d: state.retype(state.as_text_map(d.latest())),
    "known_stations": lambda d: state.known_stations(d.changes()),
    "freshness": lambda d: state.freshness(d.latest(), d.now),
    "stations_snapshot": lambda d: d.snapshot(),
    # scalar rules
    "flow_split": lambda d: d.changes().select(
        "station_id", "offset", "bikes_delta", station.taken(F.col("bikes_delta")).alias("taken"),
        station.returned(F.col("bikes_delta")).alias("returned")),
    "local_hour": lambda d: d.changes().select(
        "offset", "ts", local_hour(F.col("ts"), d.tz).alias("hour"),
        local_date(F.col("ts"), d.tz).alias("day")),
    "time_label": lambda d: d.changes().select(
        "offset", clock_label(F.col("ts"), d.tz).alias("clock"),
        day_label(local_date(F.col("ts"), d.tz)).alias("day")),
    "station_district": lambda d: d.changes().select(
        "offset", "station_code", station.district(F.col("station_code")).alias("arr")),
    "station_flags": lambda d: d.changes().select(
        "offset", station.is_empty().alias("is_empty"), station.is_full().alias("is_full"),
        station.is_out_of_order().alias("out_of_order")),
    "fill_class": lambda d: d.changes().select(
        "offset", station.fill_class("bikes").alias("bikes_class"),
        station.fill_class("docks").alias("docks_class")),
    "status_label": lambda d: d.changes().select(
        "offset", station.status_label().alias("status")),
    "age_label": _age,
    "fill_percent": lambda d: d.changes().select(
        "offset", station.fill_percent().alias("percent")),
    "delta_label": lambda d: d.changes().select(
        "offset", numbers.signed_label(F.col("bikes_delta")).alias("label")),
    "percent_label": lambda d: d.changes().select("offset", numbers.percent_label(numbers.ratio(
        F.col("bikes_available"), F.col("capacity"), 0.0)).alias("label")),
    # activity
    "activity_minutes": lambda d: activity.activity_minutes(d.changes_today(), d.day, d.tz),
    "station_flows": lambda d: activity.station_flows(d.changes_today(), d.day, d.tz),
    "activity_series_60": _series(60),
    "activity_series_300": _series(300),
    "activity_series_900": _series(900),
    "activity_series_3600": _series(3600),
    "activity_series_bad_step": _series(999),
    "activity_trimmed": lambda d: activity.trimmed(_series(300)(d)),
    "activity_top": lambda d: activity.activity_top(d.flows(), d.latest()),
    # operator view
    "business_totals": lambda d: business.business_totals(d.latest(), d.flows()),
    "business_rebalance": lambda d: business.business_rebalance(d.latest(), d.flows()),
    "business_sinks": lambda d: business.business_sinks(d.latest(), d.flows()),
    "business_sources": lambda d: business.business_sources(d.latest(), d.flows()),
    "business_revenue": lambda d: business.business_revenue(
        d.latest(), d.flows(), bindings.PRICE),
    "top_active": lambda d: business.most_active(d.snapshot()),
    "bottom_active": lambda d: business.most_active(d.snapshot(), least=True),
    "top_active_district": lambda d: business.most_active(
        d.snapshot(), district=bindings.DISTRICT),
    "bottom_active_district": lambda d: business.most_active(
        d.snapshot(), district=bindings.DISTRICT, least=True),
    "top_fill_district": lambda d: business.fullest(d.latest(), district=bindings.DISTRICT),
    "bottom_fill_district": lambda d: business.fullest(
        d.latest(), district=bindings.DISTRICT, emptiest=True),
    "top_fill": lambda d: business.fullest(d.latest()),
    "bottom_fill": lambda d: business.fullest(d.latest(), emptiest=True),
    "station_search": lambda d: search.station_search(d.latest(), bindings.SEARCH),
    # districts
    "districts": lambda d: d.districts(),
    "district_heat": lambda d: districts.heat(d.districts()),
    "district_map": lambda d: districts.district_map(d.features(), d.districts()),
    "city_overview": lambda d: districts.city_overview(d.districts()),
    "district_detail": lambda d: districts.district_detail(d.districts(), bindings.DISTRICT),
    "map_clusters": lambda d: districts.map_clusters(d.latest()),
    "map_clusters_docks": lambda d: districts.map_clusters(d.latest(), "docks"),
    # history
    "history_daily": lambda d: history.history_daily(d.hours()),
    "history_profile": lambda d: history.history_profile(d.hours()),
    "archive_summary": lambda d: history.archive_summary(d.hours()),
    # indicators
    "header_stats": lambda d: indicators.header_stats(d.latest()),
    "kpi_instant": lambda d: indicators.kpi_instant(d.latest()),
    "kpi_day": lambda d: indicators.kpi_day(d.minutes(), d.now),
    "kpi_peak_hour": lambda d: indicators.kpi_peak_hour(d.minutes(), d.tz),
    "kpi_sparkline": lambda d: activity.sparkline(d.minutes(), d.now),
    "today_vs_average": lambda d: indicators.today_vs_average(
        d.minutes(), history.history_daily(d.hours_before())),
    "day_projection": lambda d: indicators.day_projection(
        history.history_profile(d.hours_before()), d.flows(), d.now, d.tz),
}


# Plans that are made from the driver's own tables; all others serve any landed documents.
_BOUND = {"info_scan", "status_scan", "bike_types", "poison_good", "poison_rejected"}
VIEWS = sorted(set(PLANS) - _BOUND)


def view(name: str, derived: Derived) -> DataFrame:
    """One of the VIEWS over the given tables."""
    return PLANS[name](derived)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(plan: Plan):
        return lambda spark, sf_dir: plan(Derived(spark, sf_dir))

    return {name: bound(plan) for name, plan in {**PLANS, **STREAMS}.items()}
