"""Physical plans: one narrow shuffle, pruned scans, no cross joins or Python."""

import re

import pytest
from pyspark.sql import functions as F

from dockflow.plans import streams
from dockflow.plans.catalog import PLANS
from dockflow.plans.derived import Derived

SF_DIR = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "PythonRunner")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def derived(spark):
    return Derived(spark, SF_DIR)


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_readings_are_shuffled_by_station_and_chunk(spark, derived, threshold):
    """Also when information is too large to be broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = [spark.conf.get(k, None) for k in keys]
    try:
        for key in keys:
            spark.conf.set(key, threshold)
        text = plan(derived.detected())
    finally:
        for key, value in zip(keys, before):
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    lines = text.splitlines()
    window = next(i for i, line in enumerate(lines) if "Window [lag(" in line)
    exchange = next(line for line in lines[window:] if "Exchange " in line)
    assert "hashpartitioning(station_id" in exchange and ", _chunk" in exchange
    # names and places are not in the shuffled rows
    below = "\n".join(lines[window:lines.index(exchange)])
    assert "station_code" not in below and "capacity" not in below


def test_changes_read_their_source_once(spark, derived):
    """The two windows of change detection share the shuffle of the readings."""
    df = derived.detected()
    df.collect()
    text = plan(df).split("== Initial Plan ==")[0]  # how it ran in the end
    assert "isFinalPlan=true" in text and "ReusedExchange" in text
    assert text.count("FileScan parquet [event_id") == 1


def test_day_queries_read_few_partitions(derived):
    text = plan(derived.changes_today())
    assert "date#" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(ts," in text.split("PushedFilters: [")[1]


def test_the_shuffle_of_readings_follows_the_input(spark, derived, monkeypatch):
    """Of the change detection alone, without a shared table being asked for first."""
    fresh = Derived(spark, SF_DIR)
    monkeypatch.setattr(fresh, "source_bytes", lambda: 300 * 256 * 1024 ** 2)
    line = next(x for x in plan(fresh.detected()).splitlines() if ", _chunk" in x and "hashpartitioning" in x)
    assert ", 300)" in line and int(spark.conf.get("spark.sql.shuffle.partitions")) < 300


def test_a_day_of_an_encoded_log_is_read_alone(spark, derived, tmp_path):
    """Batch and stream: folders of other publish dates are not opened."""
    from datetime import date

    from pyspark.sql import functions as F

    from dockflow.__main__ import read_log_table
    from dockflow.functions.clock import local_date
    from dockflow.sources.log import encode_log
    from dockflow.streaming.tables import DatedTable

    table = DatedTable(spark, str(tmp_path / "log"), "key string, value string, partition int, offset bigint, publish_ts bigint")
    records = encode_log(derived.changes()).withColumn("date", local_date(F.col("publish_ts"), derived.tz))
    for batch in range(2):
        table.write(records, batch)
    table.write(records, 1)  # a repeated batch replaces its own
    assert table.read().count() == 2 * records.count()
    day = date.fromisoformat(derived.day)
    one = read_log_table(spark, table.base, day, day)
    assert "date#" in plan(one).split("PartitionFilters: [")[1].split("]")[0]
    assert one.count() == 2 * records.where(F.col("date") == str(day)).count() > 0


@pytest.mark.parametrize("name", ["history_daily", "history_profile", "archive_summary", "today_vs_average", "day_projection"])
def test_histories_read_sums_and_no_events(derived, name):
    text = plan(PLANS[name](derived))
    assert "/_hours" in text and "bikes_delta" not in text


def test_lists_are_taken_in_order_without_a_full_sort(derived):
    for name in ("business_rebalance", "business_sinks", "top_active", "station_search"):
        assert "TakeOrderedAndProject" in plan(PLANS[name](derived))


@pytest.mark.parametrize("name", list(PLANS))
def test_no_cross_join_and_no_python(derived, name):
    text = plan(PLANS[name](derived))
    assert not [word for word in FORBIDDEN if word in text]


def test_shuffles_follow_the_rows_and_not_their_files(spark, monkeypatch):
    """Parquet files of 720 MB hold rows of many GB, which two or three partitions would not sort in memory."""
    monkeypatch.setattr(Derived, "source_bytes", lambda d: 720 * 1024 ** 2)
    detected = plan(Derived(spark, SF_DIR).detected())
    assert re.search(r"hashpartitioning\(station_id#\d+L, _chunk#\d+L, 57\)", detected)


def test_landing_computes_its_records_once(spark):
    rows = streams._twice(spark.range(3).select(F.to_json(F.struct("id")).alias("value")))
    assert sorted(r[0] for r in rows.collect()) == sorted(2 * [f'{{"id":{n}}}' for n in range(3)])
    assert plan(rows).count("Range (") == 1
