import json

import pytest
from pyspark.sql import functions as F

from tables import DAY, START, one, rows
from dockflow import schemas
from dockflow.operators.readings import feed_summary, readings
from dockflow.sources import archive, documents, files, log

INFORMATION = {"data": {"stations": [
    {"station_id": 1, "stationCode": "14055", "name": "Quay", "lat": 45.8, "lon": 4.2, "capacity": 9},
    {"station_id": 2, "stationCode": None, "name": None, "lat": 48.9, "lon": 2.3, "capacity": None},
    {"station_id": 1, "stationCode": "14055", "name": "Harbour", "lat": 45.1, "lon": 4.4, "capacity": 33},
    {"station_id": 4, "lat": 48.7, "lon": 2.4},
    {"station_id": 5, "name": "Nowhere"}]}}

STATUS = {"lastUpdatedOther": 1784321000, "ttl": 3600, "data": {"stations": [
    {"station_id": 1, "num_bikes_available": 5, "num_bikes_available_types": [{"mechanical": 3}, {"ebike": 2}],
     "num_docks_available": 30, "is_installed": 1, "is_renting": 1, "is_returning": 1,
     "last_reported": 1784320400},
    {"station_id": 2, "num_bikes_available": None, "num_bikes_available_types": [{"ebike": 4}, {"mechanical": 1}],
     "num_docks_available": None, "is_installed": None, "is_renting": 0, "last_reported": 0},
    {"station_id": 3, "num_bikes_available": 7, "is_installed": 1},
    {"station_id": 4, "num_bikes_available": 0, "num_bikes_available_types": [{"mechanical": 6}],
     "is_installed": 1, "is_renting": 2}]}}


def land(path, *documents_):
    path.mkdir()
    for i, doc in enumerate(documents_):
        (path / f"{i}.json").write_text(doc if isinstance(doc, str) else json.dumps(doc, indent=1))
    return str(path)


def test_station_info(spark, tmp_path):
    path = land(tmp_path / "info", INFORMATION)
    info = documents.station_info(documents.read_documents(spark, path, schemas.INFORMATION_SCHEMA))
    assert rows(info) == [
        (1, "14055", "Harbour", 45.1, 4.4, 33), (2, "", "", 48.9, 2.3, 0), (4, "", "", 48.7, 2.4, 0)]


def test_the_document_that_arrived_last_counts(spark, tmp_path):
    """Whatever the position inside it: the older one lists the station later."""
    import os

    entry = {"station_id": 7, "lat": 1.0, "lon": 2.0}
    older = {"data": {"stations": [{"station_id": 8, "lat": 0.0, "lon": 0.0}, {**entry, "name": "older"}]}}
    newer = {"data": {"stations": [{**entry, "name": "newer"}]}}
    path = land(tmp_path / "info", newer, older)
    os.utime(tmp_path / "info" / "0.json", (2000, 2000))
    os.utime(tmp_path / "info" / "1.json", (1000, 1000))
    info = documents.station_info(documents.read_documents(spark, path, schemas.INFORMATION_SCHEMA))
    assert rows(info, "station_id", "name") == [(7, "newer"), (8, "")]


def test_record_metadata_per_record(spark):
    """A document without offset or record time takes its place and its own time instead."""
    entry = {"station_id": 1, "is_installed": 1}
    docs = [json.dumps({"lastUpdatedOther": 50, "offset": 9, "publish_ts": 60, "data": {"stations": [entry]}}),
            json.dumps({"lastUpdatedOther": 70, "data": {"stations": [entry, entry]}}, indent=2)]
    texts = spark.createDataFrame([("\n".join(docs),)], "value string")
    from dockflow.streaming.queries import parse_polls
    scanned = documents.status_scan(parse_polls(documents.split_documents(texts)))
    assert rows(scanned, "ts", "offset", "publish_ts") == [(50, 9, 60), (70, 0, 70), (70, 1, 70)]


def test_readings_join_and_null_rules(spark, tmp_path):
    info = documents.station_info(documents.read_documents(
        spark, land(tmp_path / "info", INFORMATION), schemas.INFORMATION_SCHEMA))
    # a broken document is skipped, the others count
    status = documents.status_scan(documents.read_documents(
        spark, land(tmp_path / "status", STATUS, '{"lastUpdatedOther": 1,'), schemas.STATUS_SCHEMA))
    assert status.count() == 4
    states = readings(status, info)
    got = rows(states, "station_id", "ts", "last_reported", "mechanical", "ebike", "bikes_available",
               "docks_available", "is_installed", "is_renting", "is_returning")
    assert got == [
        (1, 1784321000, 1784320400, 3, 2, 5, 30, True, True, True),
        (2, 1784321000, 1784321000, 1, 4, 5, 0, False, False, False),
        (4, 1784321000, 1784321000, 6, 0, 0, 0, True, True, False)]
    assert one(feed_summary(info, states)) == {"info": 3, "joined": 3, "bikes": 10, "empty": 1}


def test_weather(spark, tmp_path):
    doc = {"hourly": {
        "time": ["2026-07-18T00:00", "2026-07-18T22:00"], "precipitation": [0.4, 0.9],
        "temperature_2m": [11.5, 9.0], "wind_speed_10m": [3.5, 8.0],
        "relative_humidity_2m": [41, 87], "weather_code": [3, 80]}}
    hours = documents.weather_hourly(documents.read_documents(
        spark, land(tmp_path / "wx", doc), schemas.WEATHER_DOCUMENT_SCHEMA))
    assert rows(hours) == [
        (1784332800, 2, 0.4, 11.5, 3.5, 41.0, 3, hours.first()["date"]),
        (1784412000, 0, 0.9, 9.0, 8.0, 87.0, 80, hours.first()["date"])]
    base = str(tmp_path / "weather")
    archive.archive_weather(hours, base, DAY)
    archive.archive_weather(hours, base, DAY)  # a second run replaces the first
    stored = archive.read_weather_archive(spark, base)
    assert rows(stored, "date", "ts", "hour", "humidity") == rows(hours, "date", "ts", "hour", "humidity")
    assert stored.where("date = '2026-07-17'").count() == 0


def test_geojson_bbox_over_both_geometry_types(spark, tmp_path):
    doc = {"type": "FeatureCollection", "features": [
        {"properties": {"arr": 1}, "geometry": {"type": "Polygon", "coordinates": [
            [[2.30, 48.80], [2.32, 48.80], [2.32, 48.82], [2.30, 48.80]],
            [[2.31, 48.81], [2.311, 48.81], [2.31, 48.81]]]}},
        {"properties": {"arr": 2}, "geometry": {"type": "MultiPolygon", "coordinates": [
            [[[2.40, 48.85], [2.42, 48.86], [2.40, 48.85]]],
            [[[2.20, 48.90], [2.21, 48.91], [2.20, 48.90]]]]}}]}
    features = documents.read_features(spark, land(tmp_path / "geo", doc))
    assert documents.district_rings(features).count() == 4
    box = one(documents.geo_bbox(features))
    assert box == pytest.approx(
        {"min_lon": 2.195, "max_lon": 2.425, "min_lat": 48.795, "max_lat": 48.915})


def test_log_round_trip(make_events):
    events = make_events(dict(station_id=407000113, bikes_delta=-2), dict(station_id=5, name='a "b" é'))
    records = log.encode_log(events)
    assert rows(records, "key") == [("407000113",), ("5",)]
    value = json.loads(records.where("key = '407000113'").first()["value"])
    assert list(value) == schemas.EVENT_FIELDS and value["is_installed"] is True
    good, rejected = log.decode_log(records)
    assert rows(good) == rows(events) and rejected.count() == 0


def test_poison_records(spark, make_events):
    value = log.encode_log(make_events({})).first()["value"]
    event = json.loads(value)
    without = {k: v for k, v in event.items() if k != "ebike"}
    cases = {
        "{broken": "not_an_object", "[1]": "not_an_object", '"text"': "not_an_object", "": "not_an_object",
        json.dumps([event]): "not_an_object",
        '{"shape": "unknown"}': "wrong_fields", json.dumps(without): "wrong_fields",
        json.dumps({**event, "extra": 1}): "wrong_fields",
        json.dumps({**event, "name": None}): "null_field",
        json.dumps({**event, "capacity": "many"}): "null_field",
        value: None, json.dumps(dict(reversed(event.items()))): None,
    }
    data = [("1", v, 0, i, 0) for i, v in enumerate(cases)]
    good, rejected = log.decode_log(spark.createDataFrame(data, schemas.LOG_SCHEMA))
    want = [(i, reason) for i, reason in enumerate(cases.values()) if reason]
    assert sorted((r["offset"], r["reason"]) for r in rejected.collect()) == want
    assert good.count() == 2


def test_null_value_is_rejected(spark):
    data = spark.createDataFrame([("1", None, 0, 0, 0)], schemas.LOG_SCHEMA)
    good, rejected = log.decode_log(data)
    assert good.count() == 0 and rejected.first()["reason"] == "not_an_object"


def test_log_day_is_cut_by_publish_time(make_events):
    end = START + 86400
    events = make_events(
        dict(ts=START - 60, publish_ts=START - 1), dict(ts=START - 5, publish_ts=START),
        dict(ts=START, publish_ts=end - 1), dict(ts=end - 1, publish_ts=end))
    assert rows(log.read_log_days(events, DAY), "offset") == [(1,), (2,)]
    assert rows(log.read_log_days(events, "2026-07-17", "2026-07-19"), "offset") == [
        (0,), (1,), (2,), (3,)]
    assert log.read_log_days(events, "2026-07-25").count() == 0


def test_monitor_line(make_events):
    df = make_events(dict(bikes_delta=-2), dict(name="x" * 50, bikes_available=1234, bikes_delta=3))
    assert rows(log.monitor_line(df), "line") == [
        ("Dock A                                5 vélos (-2)",), ("x" * 35 + " 1234 vélos (+3)",)]


def test_archive_write_read_and_rerun(spark, make_events, tmp_path):
    base, mirror = str(tmp_path / "events"), str(tmp_path / "mirror")
    day = make_events(
        dict(ts=START + 3660, bikes_delta=-1), dict(ts=START + 3600, bikes_delta=2),
        dict(ts=START - 30, publish_ts=START + 5), dict(ts=START - 90, publish_ts=START - 80))
    archive.archive_events(day, base, first_day=DAY, mirror_base=mirror)
    archive.archive_events(day, base, first_day=DAY, mirror_base=mirror)
    stored = archive.read_event_archive(spark, base)
    # date from publish time, hour from event time
    got = rows(stored.withColumn("date", F.col("date").cast("string")), "date", "hour", "bikes_delta")
    assert got == [(DAY, 1, -1), (DAY, 1, 2), (DAY, 23, 0)]
    assert {f.name: f.dataType.simpleString() for f in stored.schema} == {
        **schemas.ARCHIVE_EVENT_TYPES, "date": "date"}
    assert rows(archive.read_event_archive(spark, mirror)) == rows(stored)
    # another day is added, the first one stays
    archive.archive_events(day, base, first_day="2026-07-17")
    assert archive.read_event_archive(spark, base).count() == 4
    assert archive.read_event_archive(spark, mirror).count() == 3


def test_a_run_that_fails_between_dates_leaves_the_old_archive(spark, make_events, tmp_path, monkeypatch):
    base = str(tmp_path / "events")
    days = [dict(ts=START + n * 86400 + 60, bikes_delta=n - 1) for n in range(3)]
    archive.archive_events(make_events(*days[:2]), base)
    before = rows(archive.read_event_archive(spark, base)), rows(archive.read_hour_sums(spark, base))
    move, moved = files.move, []

    def failing(spark, path, to):
        moved.append(to)
        if len(moved) == 4:
            raise OSError("the store went away")
        move(spark, path, to)

    changed = make_events(*[{**d, "station_id": 9, "bikes_delta": 5} for d in days])
    monkeypatch.setattr(files, "move", failing)
    with pytest.raises(OSError, match="went away"):
        archive.archive_events(changed, base)
    monkeypatch.setattr(files, "move", move)
    assert (rows(archive.read_event_archive(spark, base)), rows(archive.read_hour_sums(spark, base))) == before
    archive.archive_events(changed, base)
    assert rows(archive.read_event_archive(spark, base), "station_id") == [(9,)] * 3
    assert sorted(p.name for p in (tmp_path / "events").iterdir() if p.name.startswith("_")) == ["_hours"]


def test_a_crash_between_dates_is_undone_by_the_next_reader(spark, make_events, tmp_path, monkeypatch):
    base = str(tmp_path / "events")
    days = [dict(ts=START + n * 86400 + 60, bikes_delta=1) for n in range(3)]
    archive.archive_events(make_events(*days[:2]), base)
    before = rows(archive.read_event_archive(spark, base)), rows(archive.read_hour_sums(spark, base))
    for stop in (1, 2, 3, 5, 6):
        move, moved = files.move, []

        def dying(spark, path, to):
            moved.append(to)
            if len(moved) == stop:  # noqa: B023
                raise KeyboardInterrupt
            move(spark, path, to)  # noqa: B023

        monkeypatch.setattr(files, "move", dying)
        with pytest.raises(KeyboardInterrupt):
            archive.archive_events(make_events(*[{**d, "station_id": 9} for d in days]), base)
        monkeypatch.setattr(files, "move", move)
        assert (rows(archive.read_event_archive(spark, base)), rows(archive.read_hour_sums(spark, base))) == before


def test_runs_count_while_they_write(spark, make_events, tmp_path):
    events = make_events(dict(ts=START + 60, bikes_delta=-2), dict(ts=START + 61, bikes_delta=3), dict(ts=START + 86400, bikes_delta=0))
    mirror = str(tmp_path / "mirror")
    archive.archive_events(make_events(dict(ts=START - 86400)), str(tmp_path / "events"), mirror_base=None)
    run = archive.archive_events(events, str(tmp_path / "events"), mirror_base=mirror)
    assert run.dates == ["2026-07-18", "2026-07-19"] and run.totals == {"events": 3, "taken": 2, "returned": 3}
    assert sorted(p.name for p in (tmp_path / "mirror").glob("date=*")) == ["date=2026-07-18", "date=2026-07-19"]  # of this run only
    assert rows(archive.read_hour_sums(spark, mirror), "hour", "events", "taken", "returned") == [(0, 1, 0, 0), (0, 2, 2, 3)]
    hours = spark.createDataFrame([(1, 2, 0.5, 11.0, 1.0, 40.0, 3, DAY), (2, 3, 0.25, 9.0, 1.0, 40.0, 3, DAY)],
                                  "ts bigint, hour int, precipitation double, temperature double, wind_speed double, humidity double, "
                                  "weather_code int, date string").withColumn("date", F.col("date").cast("date"))
    weather = archive.archive_weather(hours, str(tmp_path / "weather"), DAY, "2026-07-19")
    assert archive.weather_totals(weather) == [(DAY, 0.75, 9.0, 11.0)]


def test_archive_files_are_sorted_by_time(spark, make_events, tmp_path):
    base = str(tmp_path / "events")
    events = make_events(*[dict(station_id=i, ts=START + (i * 7919) % 3600) for i in range(200)])
    archive.archive_events(events, base)
    for path in spark.read.parquet(base).inputFiles():
        times = [r["ts"] for r in spark.read.parquet(path).select("ts").collect()]
        assert times == sorted(times)


def test_archive_of_no_events_writes_nothing(spark, make_events, tmp_path):
    base = str(tmp_path / "events")
    archive.archive_events(make_events({}), base, first_day="2020-01-01")
    assert archive.read_event_archive(spark, base).count() == 0


def test_missing_archive_is_empty(spark, tmp_path):
    assert archive.read_event_archive(spark, str(tmp_path / "none")).count() == 0
    assert not files.exists(spark, str(tmp_path / "none"))


def test_fingerprint_sees_changes(spark, tmp_path):
    (tmp_path / "a").write_text("x")
    before = files.fingerprint(spark, str(tmp_path))
    (tmp_path / "b").write_text("xy")
    after = files.fingerprint(spark, str(tmp_path))
    assert before[:2] == (1, 1) and after[:2] == (2, 3)
    import os
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "c").write_text("z")
    one_ = files.fingerprint(spark, str(tmp_path))
    os.utime(tmp_path / "deep" / "c", (4e9, 4e9))  # rewritten with the same size
    assert files.fingerprint(spark, str(tmp_path)) != one_
