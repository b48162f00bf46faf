import pytest
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tables import rows
from dockflow.functions import clock, numbers, station


def column(spark, values, kind, rule):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("x"))).collect()]


def test_bike_types(spark):
    cases = [
        [{"mechanical": 3}, {"ebike": 2}], [{"ebike": 2}, {"mechanical": 3}],
        [{"mechanical": 4}], [{"ebike": 1}], [], None,
        [{"mechanical": 1}, {"mechanical": 7}], [{"cargo": 5}],
    ]
    found = column(spark, cases, "array<map<string,int>>", station.bike_types)
    assert [tuple(r) for r in found] == [
        (3, 2), (3, 2), (4, 0), (0, 1), (0, 0), (0, 0), (7, 0), (0, 0)]


def test_flag(spark):
    assert column(spark, [1, 0, None, 2], "int", station.flag) == [True, False, False, True]


def test_taken_returned(spark):
    assert column(spark, [-3, 0, 4, None], "int", station.taken) == [3, 0, 0, 0]
    assert column(spark, [-3, 0, 4, None], "int", station.returned) == [0, 0, 4, 0]


def test_district(spark):
    codes = ["16107", "16043", "1001", "20999", "21023", "00999", "N/A", "", None, "16107x", "16107.5",
             "-5000", "99999999999"]
    assert column(spark, codes, "string", station.district) == [
        16, 16, 1, 20, None, None, None, None, None, None, None, None, None]


@pytest.mark.parametrize("day, hours", [("2026-03-29", 23), ("2026-10-25", 25), ("2026-07-18", 24)])
def test_day_bounds_follow_the_calendar(day, hours):
    start, end = clock.day_bounds(day)
    assert end - start == hours * 3600


def test_local_hour_on_clock_change(spark):
    start, _ = clock.day_bounds("2026-10-25")
    found = column(spark, [start + h * 3600 for h in range(25)], "bigint", clock.local_hour)
    assert found == [0, 1, 2, 2, *range(3, 24)]
    start, _ = clock.day_bounds("2026-03-29")
    found = column(spark, [start + h * 3600 for h in range(23)], "bigint", clock.local_hour)
    assert found == [0, 1, *range(3, 24)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:07.9' AS x").select(
            clock.epoch_seconds(F.col("x")).alias("ts"))
        row = df.select("ts", clock.local_hour(F.col("ts")), clock.clock_label(F.col("ts")),
                        clock.local_date(F.col("ts")).cast("string"),
                        clock.utc_date(F.col("ts")).cast("string")).first()
        assert tuple(row) == (1710037807, 3, "03:30", "2024-03-10", "2024-03-10")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_bucket(spark):
    assert column(spark, [0, 59, 60, 3661], "bigint", lambda c: clock.bucket(c, 60)) == [0, 0, 60, 3660]


def test_day_label(spark):
    assert column(spark, ["2026-07-18"], "string", lambda c: clock.day_label(c.cast("date"))) == ["18/07"]


def test_half_up(spark):
    assert column(spark, [0.5, 1.5, 2.5, -0.5, 0.49], "double", numbers.half_up) == [1, 2, 3, 0, 0]


def test_fixed_known_ties(spark):
    values = [0.25, 0.35, 16.35, 0.05, 1.005, 99.95, 0.0]
    assert column(spark, values, "double", lambda c: numbers.fixed(c, 1)) == [
        "0,3", "0,3", "16,4", "0,1", "1,0", "100,0", "0,0"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(min_value=0, max_value=1e5, allow_nan=False), min_size=200, max_size=200))
def test_fixed_rounds_the_exact_value(spark, values):
    for digits in (1, 2):
        step = Decimal(1).scaleb(-digits)
        want = [str(Decimal(v).quantize(step, ROUND_HALF_UP)).replace(".", ",") for v in values]
        assert column(spark, values, "double", lambda c: numbers.fixed(c, digits)) == want


def test_labels(spark):
    assert column(spark, [3, -3, 0, None], "int", numbers.signed_label) == ["+3", "-3", "0", "0"]
    assert column(spark, [-5.0, 59.0, 60.0, 89.0, 90.0, 3599.0, 3600.0, 9000.0], "double",
                  numbers.age_label) == [
        "0 s", "59 s", "1 min", "1 min", "2 min", "60 min", "1 h", "3 h"]
    assert column(spark, [0.5, 0.1234], "double", numbers.percent_label) == ["50,0 %", "12,3 %"]


def test_station_predicates(make_events):
    df = make_events(
        dict(station_id=1, bikes_available=0),
        dict(station_id=2, docks_available=0),
        dict(station_id=3, is_installed=False, bikes_available=0, docks_available=0),
        dict(station_id=4, is_renting=False, is_returning=False),
        dict(station_id=5, is_renting=False, bikes_available=0),
        dict(station_id=6))
    got = rows(df, "station_id", station.is_empty(), station.is_full(), station.is_out_of_order())
    assert got == [(1, True, False, False), (2, False, True, False), (3, False, False, True),
                   (4, False, False, True), (5, False, False, False), (6, False, False, False)]


def test_fill_class_and_status(make_events):
    df = make_events(
        dict(station_id=1, bikes_available=0, docks_available=30),
        dict(station_id=2, bikes_available=8, capacity=30),
        dict(station_id=3, bikes_available=30, capacity=30, docks_available=0),
        dict(station_id=4, capacity=0),
        dict(station_id=5, is_renting=False),
        dict(station_id=6, is_returning=False),
        dict(station_id=7, is_installed=False),
        dict(station_id=8, is_renting=False, is_returning=False))
    got = rows(df, "station_id", station.fill_class("bikes"), station.fill_class("docks"))
    assert got == [
        (1, "critical", "level3"), (2, "level1", "level3"), (3, "level3", "critical"),
        (4, "level3", "level3"), (5, "closed", "level3"), (6, "level0", "closed"),
        (7, "closed", "closed"), (8, "closed", "closed")]
    labels = dict(rows(df, "station_id", station.status_label()))
    assert labels[1] == station.STATUS_OK and labels[5] == station.STATUS_NO_RENTING
    assert labels[6] == station.STATUS_NO_RETURNING and labels[7] == station.STATUS_OUT
    assert labels[8] == station.STATUS_CLOSED
    with pytest.raises(ValueError):
        station.fill_class("cars")


def test_display_name(spark):
    df = spark.createDataFrame([("A", 1), ("", 2), (None, 3)], "n string, i bigint")
    assert rows(df, station.display_name(F.col("n"), F.col("i"))) == [("2",), ("3",), ("A",)]
