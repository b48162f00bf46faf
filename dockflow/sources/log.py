"""The change log: keyed JSON records, their codec and the day read.

Records have the columns of Spark's Kafka source (`key`, `value`, `partition`,
`offset` and the record time), so a topic and a folder of files feed the same jobs.
"""

from datetime import date

from pyspark.sql import DataFrame, functions as F

from dockflow.functions.clock import DEFAULT_TZ, day_bounds
from dockflow.schemas import EVENT_FIELDS, EVENT_SCHEMA

LOG_PARTITIONS = 3

# Writer options of the Kafka sink: no loss or duplicate on retry, compressed batches.
KAFKA_SINK_OPTIONS = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.linger.ms": "5",
    "kafka.compression.type": "lz4",
}


def encode_log(changes: DataFrame, partitions: int = LOG_PARTITIONS) -> DataFrame:
    """Change events to records: key is the station id, value the 16 fields as JSON."""
    return changes.select(
        F.col("station_id").cast("string").alias("key"),
        F.to_json(F.struct(*EVENT_FIELDS)).alias("value"),
        F.pmod("station_id", F.lit(partitions)).cast("int").alias("partition"),
        "offset",
        "publish_ts",
    )


def check_log(log: DataFrame) -> DataFrame:
    """Records with their decoded `event` and the `reason` to reject it, if any.

    A record is good when its value is a JSON object with exactly the 16 fields,
    none of them null or of a wrong type. The key test is needed because
    `from_json` fills missing fields with null instead of failing. The value is
    parsed in a generator, so that later filters on the result do not repeat it.
    """
    expected = F.array(*[F.lit(f) for f in sorted(EVENT_FIELDS)])
    decoded = F.struct(
        F.from_json("value", EVENT_SCHEMA).alias("event"),
        F.sort_array(F.array_distinct(F.json_object_keys("value"))).alias("fields"))
    parsed = log.select("*", F.inline(F.array(decoded)))
    any_null = F.lit(False)
    for field in EVENT_FIELDS:
        any_null = any_null | F.col(f"event.{field}").isNull()
    return parsed.withColumn(
        "reason",
        F.when(F.col("fields").isNull(), F.lit("not_an_object"))
        .when(F.col("fields") != expected, F.lit("wrong_fields"))
        .when(any_null, F.lit("null_field")),
    ).drop("fields")


def good_events(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNull()).select("event.*", "offset", "publish_ts")


def rejected_records(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNotNull()).drop("event")


def decode_log(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split records into typed events and rejected ones with a reason."""
    checked = check_log(log)
    return good_events(checked), rejected_records(checked)


def drop_repeats(events: DataFrame) -> DataFrame:
    """Events without those that were written again: same station, time and offset."""
    return events.dropDuplicates(["station_id", "ts", "offset"])


def read_log_days(log: DataFrame, first_day: date | str, last_day: date | str | None = None,
                  tz: str = DEFAULT_TZ, partitioned: bool = False) -> DataFrame:
    """Records published within the local days, first and last included.

    A plain range on the record time: it reaches the file scan as a pushed
    filter and needs no commit or consumer position. `partitioned` says that the source
    is partitioned by `date`, the local publish date in `tz`, and prunes it to those days.
    """
    last_day = first_day if last_day is None else last_day
    start, end = day_bounds(first_day, tz)[0], day_bounds(last_day, tz)[1]
    rows = log.where((F.col("publish_ts") >= start) & (F.col("publish_ts") < end))
    if partitioned:
        rows = rows.where(F.col("date").between(
            F.lit(str(first_day)).cast("date"), F.lit(str(last_day)).cast("date")))
    return rows


def monitor_line(changes: DataFrame) -> DataFrame:
    """One console line per event."""
    line = F.format_string("%-35s %3d vélos (%+d)", F.substring("name", 1, 35),
                           F.col("bikes_available"), F.col("bikes_delta"))
    return changes.select("offset", line.alias("line"))
