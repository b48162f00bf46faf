"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is run once to warm up and then three times; the median counts. The
whole result is consumed by the `noop` sink. Writing the shared tables (change
events, archive, views) is timed once as `prepare`, in a JVM that has run change
detection before.
"""

import json
import os
import statistics
import time

from dockflow.plans.catalog import queries
from dockflow.plans.derived import Derived
from dockflow.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3

HEADLINE = [
    "info_scan", "status_scan", "weather_hourly", "readings", "detect_changes", "latest_state",
    "log_encode", "log_roundtrip", "poison_rejected", "log_day_read", "archive_events",
    "stations_snapshot", "station_flows", "activity_minutes", "activity_series_300", "activity_top",
    "business_totals", "business_rebalance", "business_sinks", "districts", "district_map",
    "map_clusters", "station_search", "history_daily", "history_profile", "header_stats",
    "kpi_instant", "kpi_day", "today_vs_average", "day_projection",
]
STREAMS = ["stream_changes", "stream_latest_view", "stream_flows"]  # timed once: they start jobs anew


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(f"local[{CPUS}]", "bench", **{
        "spark__sql__shuffle__partitions": CPUS, "spark__ui__enabled": "false",
        "spark__ui__showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    registered, seconds = queries(), {}
    derived = Derived(spark, SF_DIR)

    def prepare() -> None:
        for table in (derived.changes, derived.archive, derived.latest, derived.flows, derived.minutes):
            table()

    consume(registered["detect_changes"](spark, SF_DIR))
    seconds["prepare"] = round(timed(prepare), 3)
    for name in HEADLINE:
        run = lambda: consume(registered[name](spark, SF_DIR))  # noqa: B023, E731
        run()
        seconds[name] = round(statistics.median(timed(run) for _ in range(RUNS)), 3)
    for name in STREAMS:
        seconds[name] = round(timed(lambda: consume(registered[name](spark, SF_DIR))), 3)  # noqa: B023
    spark.stop()
    print(json.dumps({
        "metric": "total_median_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS)}))


if __name__ == "__main__":
    main()
