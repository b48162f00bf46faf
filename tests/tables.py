"""Rows that tests are built from, and helpers that read results."""

from pyspark.sql import types as T

from dockflow.functions.clock import day_bounds

DAY = "2026-07-18"
START = day_bounds(DAY)[0]

STATE = dict(
    station_id=1, station_code="00900", name="Dock A", lat=45.5, lon=4.5, capacity=30,
    ts=1784321000, last_reported=1784320400, mechanical=3, ebike=2, bikes_available=5,
    docks_available=25, is_installed=True, is_renting=True, is_returning=True)

RECORD = [T.StructField("offset", T.LongType()), T.StructField("publish_ts", T.LongType())]


def rows(df, *columns):
    """Sorted tuples of the chosen columns."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def one(df):
    """The single row as a dict."""
    found = df.collect()
    assert len(found) == 1
    return found[0].asDict()
