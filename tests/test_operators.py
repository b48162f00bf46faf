import random

import pytest
from pyspark.sql import functions as F

from tables import DAY, START, STATE, one, rows
from dockflow.operators import (activity, business, changes, districts, history, indicators, search,
                                state)
from dockflow.schemas import TRACKED_FIELDS
from dockflow.sources import archive

FLOWS = "station_id bigint, taken bigint, returned bigint"


# --- change detection --------------------------------------------------------------
def deltas(df):
    return rows(df, "station_id", "ts", "bikes_delta")


def test_first_reading_is_an_event_of_zero(make_readings):
    assert deltas(changes.detect_changes(make_readings(dict(ts=1)))) == [(1, 1, 0)]


def test_same_reading_and_times_only_give_none(make_readings):
    df = make_readings(dict(ts=1), dict(ts=2), dict(ts=3, last_reported=3))
    assert deltas(changes.detect_changes(df)) == [(1, 1, 0)]


def test_delta_and_flag_only_change(make_readings):
    df = make_readings(dict(ts=1, bikes_available=5), dict(ts=2, bikes_available=2),
                       dict(ts=3, bikes_available=2, is_renting=False))
    assert deltas(changes.detect_changes(df)) == [(1, 1, 0), (1, 2, -3), (1, 3, 0)]


def test_only_the_changed_station_of_three(make_readings):
    first = [dict(station_id=i, ts=1) for i in (1, 2, 3)]
    second = [dict(station_id=i, ts=2, bikes_available=9 if i == 2 else 5) for i in (1, 2, 3)]
    events = changes.detect_changes(make_readings(*first, *second))
    assert deltas(events.where("ts = 2")) == [(2, 2, 4)]


def test_station_twice_in_a_poll_compares_with_itself(make_readings):
    df = make_readings(dict(ts=1, bikes_available=5), dict(ts=1, bikes_available=6))
    assert deltas(changes.detect_changes(df)) == [(1, 1, 0), (1, 1, 1)]


def test_previous_state_of_earlier_runs(spark, make_readings):
    before = make_readings(dict(station_id=1, bikes_available=5), dict(station_id=3)).select(
        "station_id", *TRACKED_FIELDS)
    now = make_readings(dict(station_id=1, ts=2, bikes_available=4), dict(station_id=2, ts=2))
    assert deltas(changes.detect_changes(now, before)) == [(1, 2, -1), (2, 2, 0)]


def brute_force(readings, previous=()):
    known = {p["station_id"]: p for p in previous}
    out = []
    for r in sorted(readings, key=lambda r: (r["ts"], r["offset"])):
        before = known.get(r["station_id"])
        signature = [r[f] for f in TRACKED_FIELDS]
        if before is None:
            out.append((r["station_id"], r["ts"], r["offset"], 0))
        elif [before[f] for f in TRACKED_FIELDS] != signature:
            out.append((r["station_id"], r["ts"], r["offset"],
                        r["bikes_available"] - before["bikes_available"]))
        known[r["station_id"]] = r
    return sorted(out, key=repr)


@pytest.mark.parametrize("days", [1, 3, 40])
def test_stations_in_days_equal_brute_force(make_readings, days):
    """One station holds a third of the rows; cutting it into days changes nothing."""
    rng = random.Random(days)
    data = []
    for i in range(600):
        sid = 1 if i % 3 == 0 else rng.randint(2, 40)
        data.append({**STATE, "station_id": sid, "ts": rng.randint(0, days * 86400 - 1), "offset": i,
                     "bikes_available": rng.randint(0, 2), "is_renting": rng.random() < 0.8})
    seen = [{**STATE, "station_id": sid, "bikes_available": 1} for sid in (1, 2, 3, 99)]
    df = make_readings(*data)
    previous = make_readings(*seen).select("station_id", *TRACKED_FIELDS)
    for prev_df, prev in ((None, ()), (previous, seen)):
        events = changes.detect_changes(df, prev_df, 5)
        assert rows(events, "station_id", "ts", "offset", "bikes_delta") == brute_force(data, prev)


def test_joining_context_late_equals_joining_early(spark):
    from dockflow.operators.readings import readings

    rng = random.Random(9)
    status = spark.createDataFrame(
        [(rng.randint(1, 6), i, rng.randint(0, 3), [{"ebike": 1}], 5, 1, rng.randint(0, 1), 1, i, i, i)
         for i in range(200)],
        "station_id bigint, ts bigint, num_bikes_available int, num_bikes_available_types "
        "array<map<string,int>>, num_docks_available int, is_installed int, is_renting int, "
        "is_returning int, last_reported bigint, offset bigint, publish_ts bigint")
    info = spark.createDataFrame([(i, "1", f"S{i}", 48.0, 2.0, 9) for i in range(1, 5)],
                                 "station_id bigint, station_code string, name string, lat double, "
                                 "lon double, capacity int")
    early = changes.detect_changes(readings(status, info))
    late = changes.changes_of(status, info)
    assert rows(late) == rows(early.select(*late.columns)) and late.count() > 50


# --- state ---------------------------------------------------------------------------
def test_latest_state_replaces_the_whole_row(make_events):
    df = make_events(dict(ts=5, bikes_available=1, is_renting=False), dict(ts=9, bikes_available=2),
                     dict(ts=9, bikes_available=3), dict(station_id=2, ts=1))
    latest = state.latest_state(df)
    assert rows(latest, "station_id", "ts", "bikes_available", "is_renting") == [
        (1, 9, 3, True), (2, 1, 5, True)]
    assert rows(state.known_stations(df)) == [(1,), (2,)]


def test_text_map_and_back(make_events):
    latest = state.latest_state(make_events(dict(is_renting=False, bikes_delta=-2)))
    maps = state.as_text_map(latest)
    stored = maps.first()["fields"]
    assert stored["is_renting"] == "0" and stored["is_installed"] == "1" and stored["lat"] == "45.5"
    assert state.retype(maps).schema.simpleString() == latest.schema.simpleString()
    assert rows(state.retype(maps)) == rows(latest)


def test_freshness(make_events):
    latest = state.latest_state(make_events(dict(ts=1000)))
    assert one(state.freshness(latest, 1180)) == {
        "now": 1180, "last_ts": 1000, "age": 180, "stale": False, "label": "EN DIRECT"}
    assert one(state.freshness(latest, 1181))["label"] == "FLUX INTERROMPU"
    empty = one(state.freshness(latest.where("false"), 5))
    assert empty["last_ts"] is None and empty["stale"] is False


# --- activity --------------------------------------------------------------------------
def at(offset_s, delta, station_id=1):
    return dict(ts=START + offset_s, bikes_delta=delta, station_id=station_id)


def series(minutes, step, until):
    df = activity.activity_series(minutes, step, START, START + until)
    return [tuple(r) for r in df.orderBy("t").collect()]


def test_minute_bucket(make_events):
    minutes = activity.activity_minutes(make_events(at(600, -2), at(610, 3), at(605, 0)), DAY)
    assert rows(minutes) == [(START + 600, 3, 2, 3)]


def test_other_days_are_left_out_of_both_views(make_events):
    events = make_events(at(-30, -5), at(60, -2), at(86400, -7))
    assert rows(activity.activity_minutes(events, DAY), "taken") == [(2,)]
    assert rows(activity.station_flows(events, DAY)) == [(1, 2, 0)]


def test_long_and_short_days_end_at_real_midnight(make_events):
    from dockflow.functions.clock import day_bounds

    for day in ("2026-03-29", "2026-10-25"):
        start, end = day_bounds(day)
        events = make_events(dict(ts=start, bikes_delta=-1), dict(ts=end - 1, bikes_delta=-1),
                             dict(ts=end, bikes_delta=-1))
        assert rows(activity.station_flows(events, day)) == [(1, 2, 0)]


def test_series_has_zeros_and_merges(make_events):
    minutes = activity.activity_minutes(make_events(at(0, -1), at(600, 2)), DAY)
    assert series(minutes, 300, 600) == [
        (START, 1, 1, 0), (START + 300, 0, 0, 0), (START + 600, 1, 0, 2)]
    five = activity.activity_minutes(make_events(*[at(i * 60, -1) for i in range(5)]), DAY)
    assert series(five, 300, 299) == [(START, 5, 5, 0)]
    assert series(five, 999, 299) == series(five, 300, 299)
    late = activity.activity_minutes(make_events(at(3600, -1)), DAY)
    assert series(late, 60, 60) == [(START, 0, 0, 0), (START + 60, 0, 0, 0)]


def test_series_start_is_floored_to_the_step(make_events):
    minutes = activity.activity_minutes(make_events(at(0, -1)), DAY)
    df = activity.activity_series(minutes, 3600, START + 1800, START + 7200)
    assert [r["t"] for r in df.orderBy("t").collect()] == [START, START + 3600, START + 7200]


def test_trim_keeps_inner_zeros(make_events):
    minutes = activity.activity_minutes(
        make_events(at(0, 0), at(300, -1), at(900, 1), at(1500, 0)), DAY)
    df = activity.activity_series(minutes, 300, START, START + 1800)
    assert rows(activity.trimmed(df), "t", "taken", "returned") == [
        (START + 300, 1, 0), (START + 600, 0, 0), (START + 900, 0, 1)]
    assert activity.trimmed(df.where("taken + returned = 0")).count() == 0


def test_sparkline(make_events):
    now = START + 7205
    minutes = activity.activity_minutes(make_events(at(7200, -4), at(3660, 1), at(3599, 9)), DAY)
    points = activity.sparkline(minutes, now)
    assert points.count() == 60
    assert rows(points.where("moves > 0")) == [(START + 3660, 1), (START + 7200, 4)]


def test_top_and_flows(make_events):
    events = make_events(at(0, -1, 1), at(0, -3, 2), at(0, 2, 2), at(0, 0, 3))
    flows = activity.station_flows(events, DAY)
    assert rows(flows) == [(1, 1, 0), (2, 3, 2)]
    assert [tuple(r) for r in activity.top_stations(flows, 2).collect()] == [(2, 5), (1, 1)]
    latest = state.latest_state(make_events(dict(station_id=2, name="")))
    assert [tuple(r) for r in activity.activity_top(flows, latest).collect()] == [(2, "2", 5), (1, "1", 1)]


# --- operator view --------------------------------------------------------------------
@pytest.fixture(scope="module")
def network(spark, make_events):
    latest = state.latest_state(make_events(
        dict(station_id=1, name="Alder", bikes_available=0, mechanical=0, ebike=0),
        dict(station_id=2, name="Birch", docks_available=0),
        dict(station_id=3, name="Cedar"),
        dict(station_id=4, name="Dogwood", is_installed=False)))
    flows = spark.createDataFrame([(1, 9, 0), (2, 0, 3), (3, 1, 6), (4, 2, 0)], FLOWS)
    return latest, flows


def names(df):
    return [r["name"] for r in df.collect()]


def test_business_view(network):
    totals = one(business.business_totals(*network))
    assert totals == {"today_taken": 12, "today_returned": 9, "total_moves": 21, "at_risk_moves": 14,
                      "to_move": 9, "at_risk_share": "66,7 %"}
    rebalance = business.business_rebalance(*network)
    assert names(rebalance) == ["Alder", "Birch"]
    assert [r["state"] for r in rebalance.collect()] == ["vide", "pleine"]
    assert names(business.business_sinks(*network)) == ["Cedar", "Birch"]
    assert names(business.business_sources(*network)) == ["Alder", "Dogwood"]


def test_flows_without_a_state_count_in_totals_only(spark, network):
    latest, flows = network
    more = flows.unionByName(spark.createDataFrame([(99, 10, 0)], FLOWS))
    totals = one(business.business_totals(latest, more))
    assert (totals["today_taken"], totals["at_risk_moves"], totals["to_move"]) == (22, 14, 9)
    assert names(business.business_sources(latest, more)) == ["Alder", "Dogwood"]


def test_empty_network(network):
    latest, flows = (df.where("false") for df in network)
    assert one(business.business_totals(latest, flows)) == {
        "today_taken": 0, "today_returned": 0, "total_moves": 0, "at_risk_moves": 0, "to_move": 0,
        "at_risk_share": "–"}
    assert one(business.business_revenue(latest, flows, 1.0))["trips_per_bike"] == "–"
    assert one(indicators.kpi_instant(latest))["availability"] == "–"


def test_snapshot_defaults(network):
    latest, flows = network
    snap = business.snapshot(latest, flows.where("station_id = 1"))
    assert rows(snap, "station_id", "taken", "returned") == [(1, 9, 0), (2, 0, 0), (3, 0, 0), (4, 0, 0)]


def test_revenue(network):
    found = one(business.business_revenue(*network, 1.5))
    assert found == {"today_taken": 12, "fleet": 15, "revenue": 18, "trips_per_bike": "0,80"}


def test_rankings(network):
    snap = business.snapshot(*network)
    assert names(business.most_active(snap, 2)) == ["Alder", "Cedar"]
    assert names(business.most_active(snap, 2, least=True)) == ["Dogwood", "Birch"]
    assert business.most_active(snap, district=16).count() == 0
    assert rows(business.fullest(snap, 1), "name", "percent") == [("Birch", 17)]
    assert names(business.fullest(snap, 1, emptiest=True)) == ["Alder"]


# --- districts --------------------------------------------------------------------------
@pytest.fixture(scope="module")
def town(spark, make_events):
    latest = state.latest_state(make_events(
        dict(station_id=1, station_code="12034", lat=45.1, lon=4.1, bikes_available=4, capacity=40),
        dict(station_id=2, station_code="12101", lat=45.3, lon=4.3, bikes_available=0, capacity=20),
        dict(station_id=3, station_code="23020", lat=45.9, lon=4.43),
        dict(station_id=4, station_code="N/A", lat=45.9, lon=4.43)))
    return latest, business.snapshot(latest, spark.createDataFrame([(1, 3, 0)], FLOWS))


def test_districts(town):
    found = one(districts.districts(town[1]))
    assert (found["lat"], found["lon"]) == (pytest.approx(45.2), pytest.approx(4.2))
    assert {k: found[k] for k in ("arr", "stations", "bikes", "taken", "empty", "capacity")} == {
        "arr": 12, "stations": 2, "bikes": 4, "taken": 3, "empty": 1, "capacity": 60}
    overview = one(districts.city_overview(districts.districts(town[1])))
    assert (overview["districts"], overview["stations"], overview["fill"], overview["moves"]) == (
        1, 2, 7, 3)
    assert one(districts.district_detail(districts.districts(town[1]), 12))["fill"] == 7
    assert districts.district_detail(districts.districts(town[1]), 3).count() == 0


def test_clusters(town):
    found = rows(districts.map_clusters(town[0]), "cluster", "in_town", "n", "bikes", "level")
    assert found == [("12", True, 2, 4, "level0"), ("1530_148", False, 2, 10, "closed")]


def test_heat_and_map(spark):
    data = [(1, 5, 5, 48.8, 2.3), (2, 10, 10, 48.8, 2.3), (3, 7, 8, 48.8, 2.3)]
    by_district = spark.createDataFrame(
        data, "arr int, taken bigint, returned bigint, lat double, lon double")
    assert rows(districts.heat(by_district), "arr", "heat") == [(1, 0.0), (2, 1.0), (3, 0.5)]
    same = by_district.where("arr = 1")
    assert rows(districts.heat(same), "heat") == [(0.0,)]
    features = spark.createDataFrame(
        [({"arr": 1}, {"type": "Polygon", "coordinates": "[[[2.0,48.0],[2.1,48.0]]]"}),
         ({"arr": 9}, {"type": "MultiPolygon", "coordinates": "[[[[2.0,48.0]]],[[[2.1,48.0]]]]"})],
        "properties struct<arr:int>, geometry struct<type:string,coordinates:string>")
    assert rows(districts.district_map(features, by_district), "arr", "rings", "heat") == [
        (1, 1, 0.0), (9, 2, None)]


# --- history ----------------------------------------------------------------------------
def test_history_of_a_day(spark, make_events, tmp_path):
    base = str(tmp_path / "events")
    archive.archive_events(make_events(at(8 * 3600, -2), at(8 * 3600 + 60, 3)), base)
    stored = archive.read_hour_sums(spark, base)
    assert one(history.history_daily(stored)) == {"date": DAY, "events": 2, "taken": 2, "returned": 3}
    assert rows(history.history_profile(stored)) == [(8, 2, 3)]
    assert one(history.archive_summary(stored)) == {"events": 2, "taken": 2, "returned": 3}


def test_history_without_archives(spark, tmp_path):
    none = archive.read_hour_sums(spark, str(tmp_path / "none"))
    assert history.history_daily(none).collect() == []
    assert history.history_profile(none).collect() == []
    minutes = spark.createDataFrame([], "t bigint, events bigint, taken bigint, returned bigint")
    compared = one(indicators.today_vs_average(minutes, history.history_daily(none)))
    assert compared == {"rotations": 0, "days": 0, "average": None, "vs_average": "–"}


def test_profile_rounds_half_to_even_and_skips_absent_hours(spark):
    data = [("2026-07-01", 8, -1), ("2026-07-02", 8, -2),   # mean 1.5 -> 2
            ("2026-07-01", 9, -2), ("2026-07-02", 9, -3),   # mean 2.5 -> 2
            ("2026-07-01", 10, 4), ("2026-07-02", 10, 0)]   # second day does not count
    stored = spark.createDataFrame(data, "date string, hour int, bikes_delta int").withColumn(
        "date", F.col("date").cast("date"))
    assert rows(history.history_profile(archive.hour_sums(stored))) == [(10, 0, 4), (8, 2, 0), (9, 2, 0)]


def test_weather_daily(spark):
    data = [("2026-07-18", 0.0, 18.5), ("2026-07-18", 1.2, 17.0)]
    df = spark.createDataFrame(data, "date string, precipitation double, temperature double")
    assert rows(history.weather_daily(df)) == [("2026-07-18", 1.2, 17.0, 18.5)]


# --- indicators ----------------------------------------------------------------------------
def test_three_ways_to_count_full(make_events):
    latest = state.latest_state(make_events(
        dict(station_id=1, docks_available=0),
        dict(station_id=2, docks_available=0, is_renting=False),
        dict(station_id=3, docks_available=0, is_returning=False),
        dict(station_id=4, bikes_available=0, mechanical=0, ebike=0)))
    assert one(indicators.header_stats(latest)) == {
        "bikes": 15, "mechanical": 9, "ebike": 6, "docks": 25, "empty": 1, "full": 2, "closed": 1}
    kpi = one(indicators.kpi_instant(latest))
    assert (kpi["open"], kpi["empty"], kpi["full"], kpi["tension"]) == (3, 1, 1, 2)
    assert (kpi["fill"], kpi["electric"], kpi["availability"], kpi["open_share"]) == (
        "11,1 %", "40,0 %", "66,7 %", "75,0 %")


def test_day_indicators(make_events):
    now = START + 7230
    minutes = activity.activity_minutes(make_events(
        at(0, -3), at(3600, 2), at(3700, 1), at(7200 - 900, 4), at(7200 - 840, -1), at(7200, 2)), DAY)
    day = one(indicators.kpi_day(minutes, now))
    # the minute exactly 15 minutes back does not count
    assert day == {"events": 6, "taken": 4, "returned": 9, "rotations": 13, "net": 5, "net_label": "+5",
                   "last_15_min": 3, "rate": "0,2"}
    peak = one(indicators.kpi_peak_hour(minutes))
    assert peak == {"t": START + 3600, "hour": "1 h", "moves": 8}


def test_peak_hour_ties_and_no_movement(make_events):
    tie = activity.activity_minutes(make_events(at(7200, 2), at(0, -2)), DAY)
    assert one(indicators.kpi_peak_hour(tie))["t"] == START
    still = activity.activity_minutes(make_events(at(0, 0)), DAY)
    assert one(indicators.kpi_peak_hour(still)) == {"t": None, "hour": None, "moves": 0}


def test_projection(spark):
    profile = spark.createDataFrame([(6, 10, 0), (8, 30, 0), (9, 40, 0), (20, 20, 0)],
                                    "hour int, taken bigint, returned bigint")
    flows = spark.createDataFrame([(1, 33, 5)], FLOWS)
    found = one(indicators.day_projection(profile, flows, START + 9 * 3600 + 1800))
    assert found == {"today_taken": 33, "share": 0.6, "projected": 55, "share_label": "60,0 %"}
    early = one(indicators.day_projection(profile, flows, START + 6 * 3600 + 1200))
    assert early["projected"] is None and early["share_label"] == "–"


# --- search --------------------------------------------------------------------------------
def test_search(make_events):
    texts = ["Place République", "République - Temple", "REPUBLIQUE", "Gare du Nord", "Métro Republique"]
    latest = state.latest_state(make_events(*[
        dict(station_id=i, name=n, station_code="3001" if i == 1 else "21001")
        for i, n in enumerate(texts)]))
    found = search.station_search(latest, " répuBLique ")
    assert [r["station_id"] for r in found.collect()] == [1, 2, 0, 4]
    assert [r["place"] for r in found.collect()] == ["3ᵉ arr.", "banlieue", "banlieue", "banlieue"]
    assert found.first()["count"] == 5
    assert search.station_search(latest, "gare", "docks").first()["count"] == 25
    assert search.station_search(latest, "é").count() == 0
    assert search.station_search(latest, "république", n=2).count() == 2
