import json
import random

import pytest
from pyspark.sql import functions as F

from tables import DAY, START, STATE, rows
from dockflow.operators import activity, changes, readings, state
from dockflow.sources.log import encode_log
from dockflow.sources import kafka
from dockflow.streaming import jobs
from dockflow.streaming.queries import poll_stream
from dockflow.schemas import LOG_DDL
from dockflow.streaming.supervisor import Supervisor
from dockflow.streaming.tables import BucketView, UpdateTable

INFO = [(i, f"160{i:02d}", f"S{i}", 48.8, 2.3, 20) for i in range(1, 9)]
INFO_DDL = "station_id bigint, station_code string, name string, lat double, lon double, capacity int"


def poll(ts, offset, *stations):
    return json.dumps({"lastUpdatedOther": ts, "offset": offset, "publish_ts": ts, "data": {"stations": [
        {"station_id": sid, "num_bikes_available": bikes, "num_docks_available": 20 - bikes,
         "num_bikes_available_types": [{"mechanical": bikes}], "is_installed": 1, "is_renting": 1,
         "is_returning": 1, "last_reported": ts} for sid, bikes in stations]}})


@pytest.fixture
def poller(spark, tmp_path):
    (tmp_path / "polls").mkdir()
    info = spark.createDataFrame(INFO, INFO_DDL)
    job = jobs.ChangeJob(spark, str(tmp_path / "job"), lambda: info, delay="0 seconds", state_partitions=2)

    def run(name, *lines):
        (tmp_path / "polls" / f"{name}.json").write_text("\n".join(lines))
        query = job.start(str(tmp_path / "polls"))
        query.awaitTermination()
        return job

    return run


def emitted(job):
    return rows(job.changes.read(), "station_id", "ts", "bikes_delta")


def test_changes_survive_restarts_and_broken_polls(poller):
    poller("a", poll(60, 1, (1, 5), (2, 5)))
    poller("b", '{"lastUpdatedOther": 90, "data": ')          # source error: tick skipped
    job = poller("c", poll(120, 2, (1, 3), (2, 5)))
    assert emitted(job) == [(1, 120, -2), (1, 60, 0), (2, 60, 0)]
    job = poller("d", poll(180, 3, (2, 6), (9, 1)))           # 9 has no information, 1 not polled
    job = poller("e", poll(240, 4, (1, 4)))
    assert emitted(job) == [(1, 120, -2), (1, 240, 1), (1, 60, 0), (2, 180, 1), (2, 60, 0)]


def test_rows_of_a_batch_are_ordered_by_time(poller):
    job = poller("a", poll(180, 3, (1, 9)), poll(60, 1, (1, 5)), poll(120, 2, (1, 6)))
    assert emitted(job) == [(1, 120, 1), (1, 180, 3), (1, 60, 0)]


def test_stream_equals_batch(poller, make_readings):
    rng = random.Random(3)
    polls = [(60 * i, i, [(sid, rng.randint(0, 3)) for sid in range(1, 9) if rng.random() < 0.7])
             for i in range(1, 31)]
    for n, part in enumerate((polls[:7], polls[7:8], polls[8:])):
        job = poller(str(n), *[poll(ts, o, *stations) for ts, o, stations in part])
    flat = [dict(station_id=sid, ts=ts, offset=o, bikes_available=b, docks_available=20 - b,
                 mechanical=b, ebike=0) for ts, o, stations in polls for sid, b in stations]
    want = changes.detect_changes(make_readings(*flat))
    assert emitted(job) == rows(want, "station_id", "ts", "bikes_delta")


def test_polls_to_log_to_views(spark, poller, tmp_path):
    """The whole way: polls, change log, latest states and flows."""
    poller("a", poll(START + 60, 1, (1, 5), (2, 5)))
    job = poller("b", poll(START + 120, 2, (1, 3), (2, 5)))
    log_path = job.log.base
    views, latest = jobs.latest_view_job(spark, str(tmp_path / "latest"))
    flows = jobs.FlowsJob(spark, str(tmp_path / "flows"), state_partitions=2)
    for part in range(2):
        views.start(log_path).awaitTermination()
        flows.start(log_path).awaitTermination()
        if part == 0:
            job = poller("c", poll(START + 180, 3, (1, 4), (2, 5)))
    assert rows(latest.read(), "station_id", "name", "ts", "bikes_available") == [
        (1, "S1", START + 180, 4), (2, "S2", START + 60, 5)]
    assert rows(flows.flows()) == [(1, 2, 1)]
    assert views.rejected.read().count() == 0


def plain(ts, *stations):
    """A feed document as the feed sends it: no record metadata, indented."""
    doc = json.loads(poll(ts, 0, *stations))
    return json.dumps({k: v for k, v in doc.items() if k not in ("offset", "publish_ts")}, indent=2)


def test_plain_documents_go_all_the_way(spark, poller, tmp_path):
    """Polls, log, archive, latest view and flows without losing a row."""
    from dockflow.__main__ import main
    from dockflow.sources import archive

    stations = range(1, 9)
    poller("a", plain(START + 60, *[(s, 5) for s in stations]) + "\n" + plain(START + 120, *[(s, 6) for s in stations]))
    job = poller("b", plain(START + 180, *[(s, 3) for s in stations]))
    assert job.changes.read().count() == job.log.read().count() == 24
    assert job.changes.read().where("offset is null or publish_ts is null").count() == 0
    main(["archive", "--log", job.log.base, "--base", str(tmp_path / "archive"), DAY], spark)
    assert archive.read_event_archive(spark, str(tmp_path / "archive")).count() == 24
    views, latest = jobs.latest_view_job(spark, str(tmp_path / "latest"))
    views.start(job.log.base).awaitTermination()
    assert rows(latest.read(), "station_id", "bikes_available") == [(s, 3) for s in stations]
    flows = jobs.FlowsJob(spark, str(tmp_path / "flows"), state_partitions=2)
    flows.start(job.log.base, since=DAY).awaitTermination()
    assert rows(flows.flows()) == [(s, 3, 1) for s in stations]


def test_texts_that_are_no_documents_are_kept(poller):
    poller("a", poll(60, 1, (1, 5)))
    job = poller("b", '{"lastUpdatedOther": 90, "data": ')
    assert [r["value"].strip() for r in job.rejected.read().collect()] == ['{"lastUpdatedOther": 90, "data":']


def test_polls_that_land_late_meet_their_true_predecessor(spark, tmp_path):
    """Any order of arrival within the delay gives the events of the batch."""
    info = spark.createDataFrame(INFO, INFO_DDL)
    job = jobs.ChangeJob(spark, str(tmp_path / "job"), lambda: info, delay="10 minutes", state_partitions=2)
    (tmp_path / "polls").mkdir()
    order = [(1000, 1, 5), (1120, 3, 9), (1060, 2, 7), (1180, 4, 9), (1150, 5, 8), (1060, 2, 7)]
    for n, (ts, offset, bikes) in enumerate([*order, (3000, 9, None)]):  # the last poll has no stations
        stations = [] if bikes is None else [(1, bikes)]
        (tmp_path / "polls" / f"{n}.json").write_text(poll(ts, offset, *stations))
        job.start(str(tmp_path / "polls")).awaitTermination()
        if n == 3:
            assert emitted(job) == []  # all may still have predecessors on the way
    assert emitted(job) == [(1, 1000, 0), (1, 1060, 2), (1, 1120, 2), (1, 1150, -1), (1, 1180, 1)]


def test_shuffled_and_repeated_polls_equal_batch(spark, tmp_path, make_readings):
    rng = random.Random(11)
    polls = [(60 * i, i, [(sid, rng.randint(0, 3)) for sid in range(1, 9) if rng.random() < 0.7]) for i in range(1, 41)]
    arriving = sorted([*polls, *polls[::3]], key=lambda p: p[0] + rng.randint(0, 600))
    info = spark.createDataFrame(INFO, INFO_DDL)
    job = jobs.ChangeJob(spark, str(tmp_path / "job"), lambda: info, delay="601 seconds", state_partitions=2)
    (tmp_path / "polls").mkdir()
    for n in range(0, len(arriving), 18):
        lines = [poll(ts, o, *stations) for ts, o, stations in arriving[n:n + 18]]
        (tmp_path / "polls" / f"{n}.json").write_text("\n".join(lines))
        job.start(str(tmp_path / "polls")).awaitTermination()
    (tmp_path / "polls" / "end.json").write_text(poll(9000, 99))
    job.start(str(tmp_path / "polls")).awaitTermination()
    flat = [dict(station_id=sid, ts=ts, offset=o, bikes_available=b, docks_available=20 - b,
                 mechanical=b, ebike=0) for ts, o, stations in polls for sid, b in stations]
    assert emitted(job) == rows(changes.detect_changes(make_readings(*flat)), "station_id", "ts", "bikes_delta")


def test_repeated_batch_changes_nothing(spark, tmp_path, make_events):
    info = spark.createDataFrame(INFO, INFO_DDL)
    job = jobs.ChangeJob(spark, str(tmp_path / "job"), lambda: info)
    texts = spark.createDataFrame([(poll(60, 1, (1, 5)),)], "value string")
    for _ in range(2):
        job.land(texts, 0)
        job.emit(make_events(dict(station_id=1, ts=60)).drop("station_code", "name", "lat", "lon", "capacity"), 0)
    assert rows(job.readings.read(), "station_id", "ts") == [(1, 60), (None, 60)]
    assert job.changes.read().count() == job.log.read().count() == 1


def test_a_missing_manifest_is_an_error(spark, tmp_path):
    view = BucketView(spark, str(tmp_path / "v"), "k bigint, n bigint", "k", ["n"])
    one = spark.createDataFrame([(1, 1)], "k bigint, n bigint")
    view.upsert(one, 0)
    with pytest.raises(Exception, match="FileNotFound|does not exist"):
        view.upsert(one, 5)


def test_events_that_timers_release_are_not_broadcast(poller, monkeypatch):
    """A batch that only moves the clock has no input, but its events may be many."""
    described = []
    monkeypatch.setattr(jobs, "describe", lambda *a: described.append(readings.describe(*a)) or described[-1])
    job = poller("a", poll(60, 1, (1, 5), (2, 5)), poll(120, 2, (1, 3), (2, 5)))
    assert emitted(job) == [(1, 120, -2), (1, 60, 0), (2, 60, 0)]
    plans = [d._jdf.queryExecution().executedPlan().toString() for d in described]
    assert len(plans) >= 2 and not any("BroadcastExchange" in p for p in plans)


def test_records_are_published_as_well(spark, tmp_path, make_events):
    sent = []
    info = spark.createDataFrame(INFO, INFO_DDL)
    job = jobs.ChangeJob(spark, str(tmp_path / "job"), lambda: info,
                         publish=lambda records, batch: sent.append((batch, records.count())))
    events = make_events(dict(station_id=1), dict(station_id=2))
    job.emit(events.drop("station_code", "name", "lat", "lon", "capacity"), 0)
    assert sent == [(0, 2)]


class Recorder:
    """Stands in for a reader or writer and notes its options; no broker is needed."""

    def __init__(self, frame):
        self.frame, self.seen = frame, {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def options(self, **options):
        self.seen |= options
        return self

    def load(self):
        return self.frame

    def save(self):
        self.seen["saved"] = True


def test_topic_options(spark):
    frame = spark.createDataFrame([], "key binary, value binary, partition int, offset bigint, timestamp timestamp")

    class Session:
        readStream, read = Recorder(frame), Recorder(frame)

    got = kafka.stream_log(Session, "b:1", "log", since=DAY)
    assert got.columns == ["key", "value", "partition", "offset", "publish_ts"]
    assert Session.readStream.seen == {
        "format": "kafka", "kafka.bootstrap.servers": "b:1", "subscribe": "log", "maxOffsetsPerTrigger": "1000000",
        "startingTimestamp": str(START * 1000), "startingOffsetsByTimestampStrategy": "latest"}
    kafka.read_days(Session, "b:1", "log", DAY, DAY)
    assert Session.read.seen["endingTimestamp"] == str((START + 86400) * 1000)

    class Records:
        write = Recorder(None)

        def select(self, *columns):
            assert columns == ("key", "value")
            return self

    kafka.publisher("b:1", "log")(Records(), 3)
    assert Records.write.seen["saved"] and Records.write.seen["topic"] == "log"
    assert Records.write.seen["kafka.acks"] == "all" and Records.write.seen["kafka.enable.idempotence"] == "true"


def land(events, path, mode="append"):
    encode_log(events).write.mode(mode).parquet(path)


def test_latest_view_is_idempotent_and_rebuilt_by_replay(spark, make_events, tmp_path):
    path = str(tmp_path / "log")
    job, view = jobs.latest_view_job(spark, str(tmp_path / "a"))
    first = make_events(dict(station_id=1, ts=5, bikes_available=1), dict(station_id=2, ts=6))
    second = make_events(dict(station_id=1, ts=9, bikes_available=2, is_renting=False))
    for events in (first, second, first):   # the first batch arrives again
        land(events, path)
        job.start(path).awaitTermination()
    want = [(1, 9, 2, False), (2, 6, 5, True)]
    columns = ("station_id", "ts", "bikes_available", "is_renting")
    assert rows(view.read(), *columns) == want
    again, rebuilt = jobs.latest_view_job(spark, str(tmp_path / "b"))
    again.start(path).awaitTermination()
    assert rows(rebuilt.read(), *columns) == want


def test_a_large_log_is_read_in_small_splits(spark, tmp_path):
    """Records grow tens of times when they are decoded, so a job's tasks read less of a log than of other tables."""
    for job in (jobs.latest_view_job(spark, str(tmp_path / "a"))[0], jobs.LogJob(spark, str(tmp_path / "b")),
                jobs.RelayJob(spark, str(tmp_path / "c"), DAY)):
        assert job.session.conf.get("spark.sql.files.maxPartitionBytes") == "16m"
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != job.session.conf.get("spark.sql.files.maxPartitionBytes")


def test_a_batch_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    view = BucketView(spark, str(tmp_path / "v"), "k bigint, n bigint", "k", ["n"], buckets=8)
    make = lambda *r: spark.createDataFrame(list(r), "k bigint, n bigint")
    assert view.read().count() == 0
    view.upsert(make(*[(k, 0) for k in range(100)]), 0)
    folders = lambda: sorted(str(p.relative_to(tmp_path)) for p in (tmp_path / "v").glob("batch=*/bucket=*"))
    assert len(folders()) == 8
    files_before = {p: p.stat().st_mtime_ns for p in (tmp_path / "v").rglob("*.parquet")}
    view.upsert(make((7, 5), (7, 3)), 1)
    assert len([f for f in folders() if "batch=1" in f]) == 1
    assert all(p.stat().st_mtime_ns == t for p, t in files_before.items())
    want = sorted([(k, 0) for k in range(100) if k != 7] + [(7, 5)])
    assert rows(view.read()) == sorted(want, key=repr)
    view.upsert(make((7, 5), (7, 3)), 1)  # the batch is run again
    assert rows(view.read()) == sorted(want, key=repr)
    for batch in range(2, 6):
        view.upsert(make((7, batch + 10)), batch)
    assert dict(rows(view.read()))[7] == 15 and view.read().count() == 100
    assert sorted(p.name for p in (tmp_path / "v" / "manifests").glob("*.json")) == ["4.json", "5.json"]


def test_updates_are_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(UpdateTable, "COMPACT", 3)
    table = UpdateTable(spark, str(tmp_path / "u"), "k bigint, n bigint", ["k"])
    assert table.read().count() == 0
    for batch in range(8):
        update = spark.createDataFrame([(batch % 2, batch), (9, -batch)], "k bigint, n bigint")
        for _ in range(2):  # a repeated batch replaces its own
            table.write(update, batch, lambda rows: rows)
        assert dict(rows(table.read())) == {k: v for k, v in ((0, batch - batch % 2), (1, batch - (batch + 1) % 2), (9, -batch)) if v >= 0 or k == 9}
    assert [p.name for p in (tmp_path / "u" / "compacted").iterdir() if p.is_dir()] == ["v=5"]
    assert sorted(p.name for p in (tmp_path / "u" / "updates").iterdir() if p.is_dir()) == ["batch_id=6", "batch_id=7"]


def test_records_that_come_again_count_once(spark, make_events, tmp_path):
    """The log with each record twice and in any order gives what the log with each record once gives."""
    rng = random.Random(8)
    data = [dict(station_id=rng.randint(1, 3), ts=START + rng.randint(0, 3000), bikes_delta=rng.randint(-2, 2), offset=i)
            for i in range(60)]
    path = str(tmp_path / "log")
    log = jobs.LogJob(spark, str(tmp_path / "log-job"), state_partitions=2)
    flows = jobs.FlowsJob(spark, str(tmp_path / "flows"), state_partitions=2)
    minutes = jobs.ActivityJob(spark, str(tmp_path / "minutes"), state_partitions=2)
    relay = jobs.RelayJob(spark, str(tmp_path / "relay"), DAY, state_partitions=2)
    for part in (data[:30] + data[:10], data[20:] + data[::2], data):
        part = list(part)
        rng.shuffle(part)
        land(make_events(*part), path)
        for job in (log, flows, minutes):
            job.start(path).awaitTermination()
        relay.follow(path).awaitTermination()
    events = make_events(*data)
    assert rows(flows.flows()) == rows(activity.station_flows(events, DAY))
    assert rows(minutes.minutes()) == rows(relay.minutes()) == rows(activity.activity_minutes(events, DAY))
    assert rows(log.events.read(), "offset") == sorted([(i,) for i in range(60)], key=repr) == rows(relay.feed.read(), "offset")


def test_repeated_poison_is_rejected_once(spark, tmp_path):
    path = str(tmp_path / "log")
    record = spark.createDataFrame([("1", "{", 0, 5, 60), ("1", "[", 0, 5, 60), ("1", "{", 0, 5, 60)], LOG_DDL)
    job = jobs.LogJob(spark, str(tmp_path / "job"), state_partitions=2)
    for _ in range(2):
        record.write.mode("append").parquet(path)
        job.start(path).awaitTermination()
    assert rows(job.rejected.read(), "value") == [("[",), ("{",)]


def test_poison_does_not_stop_the_log(spark, make_events, tmp_path):
    path = str(tmp_path / "log")
    job = jobs.LogJob(spark, str(tmp_path / "job"))
    good = encode_log(make_events(dict(ts=1), dict(ts=2)))
    good.withColumn("value", F.when(F.col("offset") == 0, F.lit('{"shape": "unknown"}')).otherwise(
        F.col("value"))).write.parquet(path)
    job.start(path).awaitTermination()
    land(make_events(dict(ts=3)), path)
    job.start(path).awaitTermination()
    assert rows(job.events.read(), "ts") == [(2,), (3,)]
    assert rows(job.rejected.read(), "offset", "reason") == [(0, "wrong_fields")]


def test_running_aggregates_equal_batch(spark, make_events, tmp_path):
    rng = random.Random(5)
    data = [dict(station_id=rng.randint(1, 5), ts=START + rng.randint(-3600, 40000),
                 bikes_delta=rng.randint(-2, 2)) for _ in range(120)]
    data.sort(key=lambda r: r["ts"])
    path = str(tmp_path / "log")
    flows = jobs.FlowsJob(spark, str(tmp_path / "flows"), state_partitions=2)
    minutes = jobs.ActivityJob(spark, str(tmp_path / "minutes"), state_partitions=2)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for part in (data[:50], data[60:], data[50:60]):   # the last slice comes late
        land(make_events(*part), path)
        flows.start(path).awaitTermination()
        minutes.start(path).awaitTermination()
    events = make_events(*data)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert rows(flows.flows()) == rows(activity.station_flows(events, DAY))
    assert rows(minutes.minutes()) == rows(activity.activity_minutes(events, DAY))


def test_views_start_afresh_on_the_next_day(spark, make_events, tmp_path):
    path = str(tmp_path / "log")
    minutes = jobs.ActivityJob(spark, str(tmp_path / "minutes"), state_partitions=2)
    flows = jobs.FlowsJob(spark, str(tmp_path / "flows"), state_partitions=2)
    ahead = dict(ts=START + 9 * 86400, publish_ts=START + 200, bikes_delta=-7)  # a wrong clock
    for events in ([dict(ts=START + 100, bikes_delta=-1), dict(ts=START + 100, station_id=2, bikes_delta=-2)],
                   [dict(ts=START + 110, bikes_delta=-4), ahead], [dict(ts=START + 86400 + 100, bikes_delta=3)]):
        land(make_events(*events), path)
        for job in (minutes, flows):
            job.start(path).awaitTermination()
        if len(events) == 2:
            last = rows(minutes.minutes()), rows(flows.flows())
    assert last == ([(START + 60, 3, 7, 0)], [(1, 5, 0), (2, 2, 0)])
    assert rows(minutes.minutes(), "t") == [(START + 86400 + 60,)] and rows(flows.flows()) == [(1, 0, 3)]


def test_clocks_ahead_within_the_day_count_as_in_batches(spark, make_events, tmp_path):
    path = str(tmp_path / "log")
    minutes = jobs.ActivityJob(spark, str(tmp_path / "minutes"), state_partitions=2)
    flows = jobs.FlowsJob(spark, str(tmp_path / "flows"), state_partitions=2)
    data = [dict(ts=START + 82_000, publish_ts=START + 200, bikes_delta=-3),  # hours ahead, the same day
            dict(ts=START + 900, publish_ts=START + 250, bikes_delta=2),
            dict(ts=START + 100, publish_ts=START + 300, bikes_delta=-1)]
    for event in data:
        land(make_events(event), path)
        for job in (minutes, flows):
            job.start(path).awaitTermination()
    events = make_events(*data)
    assert rows(flows.flows()) == rows(activity.station_flows(events, DAY)) == [(1, 4, 2)]
    assert rows(minutes.minutes()) == rows(activity.activity_minutes(events, DAY))


def test_a_batch_of_a_running_aggregate_is_computed_once(spark, make_events, tmp_path):
    """State rows equal the stations, however often the handler uses the batch."""
    path = str(tmp_path / "log")
    job = jobs.FlowsJob(spark, str(tmp_path / "flows"), state_partitions=2)
    land(make_events(*[dict(station_id=i, ts=START + 5, bikes_delta=-1) for i in range(7)]), path)
    query = job.start(path)
    query.awaitTermination()
    operators = {o["operatorName"]: o for o in query.recentProgress[0]["stateOperators"]}  # sums, and records seen before
    assert operators["stateStoreSave"]["numRowsTotal"] == operators["stateStoreSave"]["numRowsUpdated"] == 7
    assert operators["dedupeWithinWatermark"]["numRowsTotal"] == 7


def test_replay_feeds_aggregates_and_only_live_goes_out(spark, make_events, tmp_path):
    path = str(tmp_path / "log")
    job = jobs.RelayJob(spark, str(tmp_path / "job"), DAY)
    at = dict(ts=START + 60, bikes_delta=-1)
    land(make_events(dict(ts=START - 50, bikes_delta=-9), {**at, "station_id": 1},
                     {**at, "station_id": 2}), path)
    job.replay(path).awaitTermination()
    assert job.feed.read().count() == 0
    live = encode_log(make_events(*[{**at, "station_id": 3, "offset": i} for i in range(1500)]))
    live.write.mode("append").parquet(path)
    job.follow(path).awaitTermination()
    assert rows(job.minutes()) == [(START + 60, 1502, 1502, 0)]
    assert rows(job.feed.read(), "key", "value", "offset") == rows(live, "key", "value", "offset")  # whole, as they are


def test_missing_log_is_no_failure(spark, tmp_path):
    job = jobs.RelayJob(spark, str(tmp_path / "job"), DAY)
    assert job.replay(str(tmp_path / "nothing")) is None
    assert job.minutes().count() == 0


def test_monitor_prints_every_event(spark, make_events, tmp_path, capsys):
    path = str(tmp_path / "log")
    land(make_events(*[dict(ts=i, name=f"Probe {i:02d}") for i in range(30)]), path)
    jobs.start_monitor(spark, path, str(tmp_path / "checkpoint")).awaitTermination()
    printed = capsys.readouterr().out.splitlines()
    assert [line[:8] for line in printed if line.startswith("Probe")] == [f"Probe {i:02d}" for i in range(30)]


def test_micro_batches_are_bounded(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.json").write_text(poll(i, i, (1, 5)))
    seen = []
    query = jobs.start_query(poll_stream(spark, str(tmp_path), 2), lambda df, b: seen.append(df.count()),
                             str(tmp_path / "cp"))
    query.awaitTermination()
    assert seen == [2, 2, 1]


def test_a_source_that_fails_once_is_started_again(spark, tmp_path):
    """The tick is made up for, the state survives, and the failure is a row."""
    (tmp_path / "polls").mkdir()
    info = spark.createDataFrame(INFO, INFO_DDL)
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) == 3:  # while the second poll is landed
            raise OSError("the feed is away")
        return info

    job = jobs.ChangeJob(spark, str(tmp_path / "job"), flaky, delay="0 seconds", state_partitions=2)
    for n, bikes in enumerate((5, 3, 4)):
        (tmp_path / "polls" / f"{n}.json").write_text(poll(60 * (n + 1), n, (1, bikes)))
        keeper = Supervisor(spark, lambda: job.start(str(tmp_path / "polls")), str(tmp_path / "job"), first=0.01)
        keeper.run()
    assert emitted(job) == [(1, 120, -2), (1, 180, 1), (1, 60, 0)]
    assert [("the feed is away" in r["message"], r["attempt"]) for r in keeper.failures.read().collect()] == [(True, 0)]
    assert rows(job.last_readings(), "station_id", "ts", "bikes_available") == [(1, 180, 4)]


def test_a_job_that_keeps_failing_waits_longer_and_gives_up(spark, tmp_path, monkeypatch):
    waits = []

    class Broken:
        def awaitTermination(self):  # noqa: N802
            raise OSError("no broker")

    keeper = Supervisor(spark, Broken, str(tmp_path / "job"), first=2, longest=10, attempts=5)
    monkeypatch.setattr(keeper.stopped, "wait", waits.append)
    with pytest.raises(OSError, match="no broker"):
        keeper.run()
    assert waits == [2, 4, 8, 10] and keeper.failures.read().count() == 5
    keeper.onQueryProgress(None)  # a batch went through
    keeper.in_a_row += 1
    assert keeper.wait() == 2
