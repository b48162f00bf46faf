from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

import pytest

from tables import DAY, START, rows
from dockflow.__main__ import chosen_days, main
from dockflow.sources import archive
from dockflow.streaming import jobs
from test_sources import INFORMATION, land
from test_streaming import poll


def test_chosen_days():
    yesterday = datetime.now(ZoneInfo("Europe/Paris")).date() - timedelta(days=1)
    assert chosen_days([], "Europe/Paris") == (yesterday, yesterday)
    assert chosen_days([DAY], "Europe/Paris") == (date(2026, 7, 18),) * 2
    assert chosen_days([DAY, "2026-07-20"], "UTC") == (date(2026, 7, 18), date(2026, 7, 20))
    with pytest.raises(ValueError):
        chosen_days(["18/07/2026"], "UTC")


def test_polls_to_archive(spark, tmp_path, capsys):
    info = land(tmp_path / "info", INFORMATION)
    polls = tmp_path / "polls"
    polls.mkdir()
    (polls / "a.json").write_text(poll(START + 60, 1, (1, 5), (2, 4)) + "\n" + poll(START + 120, 2, (1, 3)))
    base = str(tmp_path / "job")
    main(["changes", "--polls", str(polls), "--info", info, "--base", base, "--delay", "0 seconds", "--state-partitions", "2"], spark)
    out, mirror = str(tmp_path / "events"), str(tmp_path / "mirror")
    main(["archive", "--log", f"{base}/log", "--base", out, "--mirror", mirror, DAY], spark)
    stored = archive.read_event_archive(spark, out)
    assert rows(stored, "station_id", "bikes_delta", "hour") == [(1, -2, 0), (1, 0, 0), (2, 0, 0)]
    assert rows(archive.read_event_archive(spark, mirror)) == rows(stored)
    assert "2" in capsys.readouterr().out
    main(["latest", "--log", f"{base}/log", "--base", str(tmp_path / "view")], spark)
    main(["monitor", "--log", f"{base}/log", "--checkpoint", str(tmp_path / "cp")], spark)
    for name in ("flows", "activity"):
        main([name, "--log", f"{base}/log", "--base", str(tmp_path / name), "--state-partitions", "2",
              "--since", DAY], spark)
    flows = jobs.FlowsJob(spark, str(tmp_path / "flows"), state_partitions=2).flows()
    assert rows(flows) == [(1, 2, 0)]
    main(["relay", "--log", f"{base}/log", "--base", str(tmp_path / "relay"), "--day", DAY], spark)
    assert rows(jobs.RelayJob(spark, str(tmp_path / "relay"), DAY).minutes(), "events") == [(1,), (2,)]
    for name in ("business_totals", "latest_state", "history_daily", "detect_changes"):
        main(["query", name, "--polls", str(polls), "--info", info, "--day", DAY, "--now", str(START + 600),
              "--out", str(tmp_path / name)], spark)
    assert spark.read.parquet(str(tmp_path / "business_totals")).first()["today_taken"] == 2
    assert spark.read.parquet(str(tmp_path / "detect_changes")).count() == 3
    with pytest.raises(SystemExit):
        main(["latest", "--base", str(tmp_path / "none")], spark)


def test_weather_range(spark, tmp_path):
    times = ["2026-07-17T23:00", "2026-07-18T00:00", "2026-07-19T00:00", "2026-07-20T00:00"]
    n = len(times)
    doc = {"hourly": {"time": times, "precipitation": [0.1] * n, "temperature_2m": [18.0] * n,
                      "wind_speed_10m": [1.0] * n, "relative_humidity_2m": [50] * n,
                      "weather_code": [0] * n}}
    docs, base = land(tmp_path / "wx", doc), str(tmp_path / "weather")
    main(["weather", "--docs", docs, "--base", base, DAY, "2026-07-19"], spark)
    assert rows(archive.read_weather_archive(spark, base), "ts") == [(1784332800,), (1784419200,)]
