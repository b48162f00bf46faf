"""Keyed state of the change stream: the last reading of each station, and readings that wait for their turn.

A reading is compared with its predecessor in event time, in whatever order polls land. Readings therefore wait
until the watermark has passed them; then they are released in the order of time and offset.
"""

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from dockflow.schemas import COUNTER_SCHEMA, TRACKED_FIELDS

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package installed

FIELDS = COUNTER_SCHEMA.fieldNames()
TS, OFFSET, BIKES = (FIELDS.index(c) for c in ("ts", "offset", "bikes_available"))
TRACKED = [FIELDS.index(c) for c in TRACKED_FIELDS]
EMITTED = T.StructType(list(COUNTER_SCHEMA.fields) + [T.StructField("bikes_delta", T.IntegerType())])
EVENT = Row(*EMITTED.fieldNames())
LANDED = T.StructType([T.StructField("readings", T.ArrayType(COUNTER_SCHEMA))])


def in_order(reading: tuple) -> tuple:
    """Sort key of readings; nulls first, as in batches."""
    return tuple((reading[c] is not None, reading[c] or 0) for c in (TS, OFFSET))


def emitted(readings: list[tuple], last: tuple | None) -> Iterator[Row]:
    """The events among readings in order, after the last one before them."""
    for reading in readings:
        if last is None or any(reading[c] != last[c] for c in TRACKED):
            yield EVENT(*reading, 0 if last is None else reading[BIKES] - last[BIKES])
        last = reading


class StationChanges(StatefulProcessor):
    """`last`: the reading released last; `waiting`: later ones than the watermark, as one value for all that landed together.

    A value of its own for each reading would cost a call and a conversation with the state store for each.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", COUNTER_SCHEMA)
        self.waiting = handle.getListState("waiting", LANDED)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if key[0] is not None:  # without a station a row only moves the watermark
            found = [tuple(row[:len(FIELDS)]) for row in rows]
            self.waiting.appendValue((found,))
            self.handle.registerTimer(max(min(r[TS] for r in found) * 1000, timerValues.getCurrentWatermarkInMs() + 1))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() // 1000
        waiting = [tuple(r) for landed in self.waiting.get() for r in landed[0]]
        due = sorted((r for r in waiting if r[TS] <= passed), key=in_order)
        later = [r for r in waiting if r[TS] > passed]
        if not due:
            return
        last = tuple(self.last.get()) if self.last.exists() else None
        yield from emitted(due, last)
        self.last.update(due[-1])
        if later:
            self.waiting.put([(later,)])
            self.handle.registerTimer(min(r[TS] for r in later) * 1000)
        else:
            self.waiting.clear()


def changes_in_order(readings: DataFrame, delay: str) -> DataFrame:
    """Change events of a stream of counters, each against its true predecessor.

    A reading may come `delay` later than the newest one; it is emitted when the newest one is that much ahead.
    Rows without a station move the clock only.
    """
    timed = readings.select(*FIELDS, F.timestamp_seconds("ts").alias("event_time")).withWatermark("event_time", delay)
    return timed.groupBy("station_id").transformWithState(
        StationChanges(), EMITTED, outputMode="Append", timeMode="EventTime")


def last_readings(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The reading of each station that was released last, out of a query's checkpoint; readings that wait are not in it."""
    store = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "last").load()
    return store.select("key.station_id", *[f"value.{c}" for c in FIELDS if c != "station_id"])
