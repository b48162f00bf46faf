"""Tables derived once from the source tables and shared by many queries.

Change events feed almost every query, so they are written once per session to
the shared folder, partitioned by publish date, instead of being detected again
by each query. The same holds for the views a running system keeps up to date:
latest states, today's flows and today's minute buckets. A table is rebuilt when
its source files change.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from dockflow.functions.clock import DEFAULT_TZ, local_date
from dockflow.operators.activity import activity_minutes, of_day, station_flows
from dockflow.operators.business import snapshot
from dockflow.operators.changes import changes_of
from dockflow.operators.districts import districts
from dockflow.operators.readings import readings
from dockflow.operators.state import latest_state
from dockflow.plans import bindings
from dockflow.schemas import (EVENT_DDL, FLOWS_DDL, INFORMATION_SCHEMA, MINUTES_DDL, RECORD_DDL,
                              WEATHER_DOCUMENT_SCHEMA)
from dockflow.session import fit_shuffles, new_dir, shuffle_partitions
from dockflow.sources import archive, documents, files
from dockflow.streaming.queries import parse_polls

ROW_BYTES = 20  # of memory that rows take for a byte of their Parquet file

_written: dict[tuple, str] = {}


class Derived:
    """The views of one source folder as of the reference moment."""

    def __init__(self, spark: SparkSession, sf_dir: str, tz: str = DEFAULT_TZ,
                 day: str = bindings.DAY, now: int = bindings.NOW):
        self.spark, self.sf_dir, self.tz, self.day, self.now = spark, sf_dir, tz, day, now
        self._sources: tuple | None = None

    # --- straight from the driver's tables ----------------------------------
    def facts(self) -> DataFrame:
        return bindings.events(self.spark, self.sf_dir)

    def info(self) -> DataFrame:
        return documents.station_info(
            bindings.information_documents(bindings.supplier(self.spark, self.sf_dir)))

    def status(self) -> DataFrame:
        return bindings.status_rows(self.facts())

    def readings(self) -> DataFrame:
        return readings(self.status(), self.info())

    def detected(self) -> DataFrame:
        configured = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return changes_of(self.status(), self.info(),
                          partitions=shuffle_partitions(self.row_bytes(), configured))

    def paths(self) -> list[str]:
        """What the change events follow from."""
        return [f"{self.sf_dir}/{t}.parquet" for t in ("events", "supplier")]

    def source_bytes(self) -> int:
        if self._sources is None:
            self._sources = tuple(files.fingerprint(self.spark, path) for path in self.paths())
        return sum(size for _, size, _ in self._sources)

    def row_bytes(self) -> int:
        """What the sources take as rows, which decides how many partitions sort them without spilling."""
        return ROW_BYTES * self.source_bytes()

    def weather(self) -> DataFrame:
        return documents.weather_hourly(bindings.weather_documents(self.facts()), self.tz)

    # --- written once ---------------------------------------------------------
    def _table(self, name: str, schema: str, write: Callable[[str], None]) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.folder(name, write))

    def folder(self, name: str, write: Callable[[str], None]) -> str:
        """Where something lies that is written once for these sources and this session."""
        fit_shuffles(self.spark, self.row_bytes())
        key = (self.spark.sparkContext.applicationId, self.sf_dir, self.tz, self.day, self.now,
               name, self._sources)
        if key not in _written:
            path = new_dir(self.spark, name)
            write(path)
            _written[key] = path
        return _written[key]

    def changes(self) -> DataFrame:
        """All change events, with `date` (local publish date) as partition."""
        def write(path: str) -> None:
            rows = self.detected().withColumn("date", local_date(F.col("publish_ts"), self.tz))
            archive.write_partitions(rows, path)

        return self._table("changes", f"{RECORD_DDL}, date date", write)

    def _archive(self) -> str:
        return self.folder("archive", lambda path: archive.archive_events(self.changes(), path, self.tz))

    def archive(self) -> DataFrame:
        """The event archive of every publish date."""
        return archive.read_event_archive(self.spark, self._archive())

    def hours(self) -> DataFrame:
        """The archive's sums per date and hour, which its run wrote beside it."""
        return archive.read_hour_sums(self.spark, self._archive())

    def latest(self) -> DataFrame:
        """The view of latest states: one row per station."""
        def write(path: str) -> None:
            latest_state(self.changes()).write.parquet(path)

        return self._table("latest", EVENT_DDL, write)

    def flows(self) -> DataFrame:
        """Today's flows per station."""
        def write(path: str) -> None:
            station_flows(self.changes_today(), self.day, self.tz).write.parquet(path)

        return self._table("flows", FLOWS_DDL, write)

    def minutes(self) -> DataFrame:
        """Today's minute buckets, at most 1,500 rows."""
        def write(path: str) -> None:
            activity_minutes(self.changes_today(), self.day, self.tz).write.parquet(path)

        return self._table("minutes", MINUTES_DDL, write)

    # --- of the day -----------------------------------------------------------
    def changes_today(self) -> DataFrame:
        """The day's events among the records since its start, where a replay begins.

        A record older than that is no part of the day even if its event time is, so older
        partitions are skipped.
        """
        since = self.changes().where(F.col("date") >= F.lit(self.day).cast("date"))
        return of_day(since, self.day, self.tz)

    def hours_before(self) -> DataFrame:
        """The sums of the days before the day."""
        return self.hours().where(F.col("date") < F.lit(self.day).cast("date"))

    def snapshot(self) -> DataFrame:
        return snapshot(self.latest(), self.flows())

    def districts(self) -> DataFrame:
        return districts(self.snapshot())

    def features(self) -> DataFrame:
        return bindings.district_features(self.info())


class Landed(Derived):
    """The same views of landed documents: polls, station information, weather, districts."""

    def __init__(self, spark: SparkSession, polls: str, info: str, weather: str | None, districts: str | None,
                 tz: str, day: str, now: int):
        super().__init__(spark, polls, tz, day, now)
        self.info_path, self.weather_path, self.districts_path = info, weather, districts

    def paths(self) -> list[str]:
        return [self.sf_dir, self.info_path]

    def row_bytes(self) -> int:
        return self.source_bytes()  # JSON text takes no less room than its rows

    def info(self) -> DataFrame:
        return documents.station_info(
            documents.read_documents(self.spark, self.info_path, INFORMATION_SCHEMA))

    def status(self) -> DataFrame:
        texts = documents.split_documents(self.spark.read.text(self.sf_dir, wholetext=True))
        return documents.status_scan(parse_polls(texts).where("data.stations is not null"))

    def weather(self) -> DataFrame:
        docs = documents.read_documents(self.spark, self.weather_path, WEATHER_DOCUMENT_SCHEMA)
        return documents.weather_hourly(docs, self.tz)

    def features(self) -> DataFrame:
        return documents.read_features(self.spark, self.districts_path)
