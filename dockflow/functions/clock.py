"""Epoch seconds, local wall clock and time buckets.

Times travel as epoch seconds (UTC). Wall-clock values are computed on
TIMESTAMP_NTZ with an explicit zone, so no result depends on the session zone.
"""

from datetime import date, datetime, time, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, functions as F

DEFAULT_TZ = "Europe/Paris"


def epoch_seconds(wall: Column) -> Column:
    """Epoch seconds of a zone-less UTC timestamp."""
    days = F.datediff(F.to_date(wall), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(wall) * 3600 + F.minute(wall) * 60 + F.second(wall)


def local_time(ts: Column, tz: str = DEFAULT_TZ) -> Column:
    """Local wall clock (TIMESTAMP_NTZ) of an epoch."""
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + ts * F.expr("interval '1' second")
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def local_hour(ts: Column, tz: str = DEFAULT_TZ) -> Column:
    return F.hour(local_time(ts, tz))


def local_date(ts: Column, tz: str = DEFAULT_TZ) -> Column:
    return F.to_date(local_time(ts, tz))


def utc_date(ts: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(ts / 86400).cast("int"))


def bucket(ts: Column, step: int) -> Column:
    """Start of the epoch-aligned step that holds `ts`."""
    return ts - F.pmod(ts, F.lit(step).cast("bigint"))


def clock_label(ts: Column, tz: str = DEFAULT_TZ) -> Column:
    """Local time as HH:mm."""
    wall = local_time(ts, tz)
    return F.format_string("%02d:%02d", F.hour(wall), F.minute(wall))


def day_label(day: Column) -> Column:
    """Date as dd/MM."""
    return F.format_string("%02d/%02d", F.dayofmonth(day), F.month(day))


def as_day(day: date | str) -> date:
    return date.fromisoformat(day) if isinstance(day, str) else day


def day_bounds(day: date | str, tz: str = DEFAULT_TZ) -> tuple[int, int]:
    """Epochs of local midnight of `day` and of the next day (23 to 25 h apart)."""
    first = as_day(day)
    midnights = [
        datetime.combine(first + timedelta(days=n), time.min, ZoneInfo(tz)) for n in (0, 1)
    ]
    return int(midnights[0].timestamp()), int(midnights[1].timestamp())


def local_day(now: int, tz: str = DEFAULT_TZ) -> date:
    """Local calendar day of an epoch given as a parameter."""
    return datetime.fromtimestamp(now, ZoneInfo(tz)).date()


def local_hour_fraction(now: int, tz: str = DEFAULT_TZ) -> float:
    """Hour of the day as hours + minutes / 60, for a parameter epoch."""
    wall = datetime.fromtimestamp(now, ZoneInfo(tz))
    return wall.hour + wall.minute / 60
