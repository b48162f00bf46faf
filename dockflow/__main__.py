"""Command line of the jobs: `python -m dockflow <job> ...`.

    changes   landed polls to change events and log records
    latest    log to the view of latest states
    flows     log to the day's flows per station
    activity  log to the day's minute buckets
    relay     the day's log replayed, then followed as a live feed
    monitor   log to console lines
    archive   log to the event archive: yesterday, one day, or a range of days
    weather   landed weather documents to the weather archive, same days
    query     one registered query over landed polls and station documents

A log is a folder (`--log`) or a topic (`--servers`, `--topic`).
"""

import argparse
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession, functions as F

from dockflow.functions.clock import DEFAULT_TZ
from dockflow.plans import catalog
from dockflow.plans.derived import Landed
from dockflow.schemas import INFORMATION_SCHEMA, LOG_SCHEMA, LOG_TABLE_DDL, WEATHER_DOCUMENT_SCHEMA
from dockflow.session import build_session
from dockflow.sources import archive, documents, kafka, log
from dockflow.streaming import jobs
from dockflow.streaming.queries import MAX_FILES
from dockflow.streaming.supervisor import Supervisor


def chosen_days(days: list[str], tz: str) -> tuple[date, date]:
    """No day means yesterday, one day that day, two days the range with both."""
    if not days:
        yesterday = datetime.now(ZoneInfo(tz)).date() - timedelta(days=1)
        return yesterday, yesterday
    return date.fromisoformat(days[0]), date.fromisoformat(days[-1])


def read_log_table(spark: SparkSession, path: str, first: date, last: date) -> DataFrame:
    """Records of the days from a log below publish dates; one that lies below no date is read whole."""
    rows = spark.read.schema(LOG_TABLE_DDL).parquet(path)
    days = F.col("date").between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"))
    return rows.where(F.col("date").isNull() | days).select(*LOG_SCHEMA.fieldNames())


def read_log(spark: SparkSession, args, first: date, last: date) -> DataFrame:
    if args.topic:
        return kafka.read_days(spark, args.servers, args.topic, first, last, args.tz)
    return log.read_log_days(read_log_table(spark, args.log, first, last), first, last, args.tz)


def stream_of(spark: SparkSession, args, since: str | None = None) -> jobs.Log:
    if args.topic:
        return kafka.stream_log(spark, args.servers, args.topic, since=since, tz=args.tz)
    return args.log


def run_archive(spark: SparkSession, args) -> None:
    first, last = chosen_days(args.days, args.tz)
    events, _ = log.decode_log(read_log(spark, args, first, last))
    run = archive.archive_events(log.drop_repeats(events), args.base, args.tz, first, last, args.mirror)
    print(f"{len(run.dates)} dates,", ", ".join(f"{n} {c}" for c, n in run.totals.items()))


def run_weather(spark: SparkSession, args) -> None:
    first, last = chosen_days(args.days, args.tz)
    docs = documents.read_documents(spark, args.docs, WEATHER_DOCUMENT_SCHEMA)
    run = archive.archive_weather(documents.weather_hourly(docs, args.tz), args.base, first, last, args.mirror)
    for day, rain, lowest, highest in archive.weather_totals(run):
        print(f"{day}: rain {rain}, {lowest} to {highest} degrees")


def run_changes(spark: SparkSession, args) -> None:
    def info():
        return documents.station_info(
            documents.read_documents(spark, args.info, INFORMATION_SCHEMA))

    publish = kafka.publisher(args.servers, args.topic) if args.topic else None
    job = jobs.ChangeJob(spark, args.base, info, args.tz, args.delay, args.state_partitions, publish)
    _keep_going(spark, args, lambda: job.start(args.polls, args.interval, args.max_files), spark, job.session)


def _keep_going(spark: SparkSession, args, start, *sessions: SparkSession) -> None:
    """A job at an interval is started again when it fails; one that works off what is there fails."""
    Supervisor(spark, start, args.base, attempts=None if args.interval else 1, sessions=sessions).run()


def run_latest(spark: SparkSession, args) -> None:
    job, _ = jobs.latest_view_job(spark, args.base)
    _keep_going(spark, args, lambda: job.start(stream_of(spark, args), args.interval, args.max_files), spark)


def _run_day_job(kind: type[jobs.DayJob]):
    def run(spark: SparkSession, args) -> None:
        job = kind(spark, args.base, args.tz, state_partitions=args.state_partitions)
        source = stream_of(job.session, args, args.since)
        _keep_going(spark, args, lambda: job.start(source, args.interval, args.max_files, args.since), job.session)

    return run


def run_relay(spark: SparkSession, args) -> None:
    job = jobs.RelayJob(spark, args.base, args.day, args.tz)
    source = stream_of(spark, args, args.day)
    for query in (job.replay(source, args.max_files), job.follow(source, args.interval, args.max_files)):
        if query:
            query.awaitTermination()


def run_monitor(spark: SparkSession, args) -> None:
    jobs.start_monitor(spark, stream_of(spark, args), args.checkpoint, args.max_files).awaitTermination()


def run_query(spark: SparkSession, args) -> None:
    landed = Landed(spark, args.polls, args.info, args.weather, args.districts, args.tz, args.day, args.now)
    catalog.view(args.name, landed).write.mode("overwrite").parquet(args.out)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="dockflow", description=__doc__,
                                  formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = top.add_subparsers(required=True)

    def command(name: str, run, *paths: str, days: bool = False, stream: bool = False,
                reads_log: bool = False) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.set_defaults(run=run)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        sub.add_argument("--tz", default=DEFAULT_TZ)
        if reads_log:
            sub.add_argument("--log", help="folder of log records")
        if reads_log or name == "changes":
            sub.add_argument("--servers", help="brokers of the log's topic")
            sub.add_argument("--topic", help="topic of the log")
        if days:
            sub.add_argument("days", nargs="*", metavar="YYYY-MM-DD")
            sub.add_argument("--mirror", help="second base to write the same days to")
        if stream:
            sub.add_argument("--interval", help='e.g. "60 seconds"; without it, what is there')
            sub.add_argument("--max-files", type=int, default=MAX_FILES, help="bound of a micro-batch")
        return sub

    sub = command("changes", run_changes, "polls", "info", "base", stream=True)
    sub.add_argument("--delay", default=jobs.DELAY, help="how far behind the newest poll one may land")
    sub.add_argument("--state-partitions", type=int, help="partitions of the stations' state, fixed at the first start")
    command("latest", run_latest, "base", stream=True, reads_log=True)
    for name, kind in (("flows", jobs.FlowsJob), ("activity", jobs.ActivityJob)):
        sub = command(name, _run_day_job(kind), "base", stream=True, reads_log=True)
        sub.add_argument("--state-partitions", type=int, required=True)
        sub.add_argument("--since", help="publish date to begin at")
    command("relay", run_relay, "base", "day", stream=True, reads_log=True)
    command("monitor", run_monitor, "checkpoint", stream=True, reads_log=True)
    command("archive", run_archive, "base", days=True, reads_log=True)
    command("weather", run_weather, "docs", "base", days=True)
    sub = command("query", run_query, "polls", "info", "day", "out")
    sub.add_argument("name", choices=sorted(catalog.VIEWS))
    sub.add_argument("--now", type=int, required=True, help="epoch seconds")
    sub.add_argument("--weather", help="folder of weather documents")
    sub.add_argument("--districts", help="GeoJSON of the districts")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    top = parser()
    args = top.parse_args(argv)
    if "log" in args and not args.log and not (args.servers and args.topic):
        top.error("a log is needed: --log, or --servers and --topic")
    args.run(spark or build_session(), args)


if __name__ == "__main__":
    main()
