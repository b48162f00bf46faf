"""Latest state per station, its text form and freshness."""

from pyspark.sql import DataFrame, functions as F

from dockflow.schemas import EVENT_FIELDS, EVENT_SCHEMA

STALE_AFTER_S = 180

# The texts of the live badge.
LIVE = "EN DIRECT"
INTERRUPTED = "FLUX INTERROMPU"


def latest_by(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Last row per key; combined before the shuffle, so a hot key is no hot task."""
    others = [c for c in rows.columns if c != key]
    last = rows.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("row"))
    return last.select(key, "row.*")


def latest_state(changes: DataFrame) -> DataFrame:
    """The 16 fields of each station's last event by event time, then offset."""
    return latest_by(changes, "station_id", ["ts", "offset"]).select(*EVENT_FIELDS)


def known_stations(changes: DataFrame) -> DataFrame:
    return changes.select("station_id").distinct()


def freshness(latest: DataFrame, now: int) -> DataFrame:
    """Time of the last event, its age, and whether the flow counts as interrupted."""
    seen = latest.agg(F.max("ts").alias("last_ts")).withColumn(
        "age", F.lit(now).cast("bigint") - F.col("last_ts"))
    stale = F.coalesce(F.col("age") > STALE_AFTER_S, F.lit(False))
    return seen.select(
        F.lit(now).cast("bigint").alias("now"), "last_ts", "age", stale.alias("stale"),
        F.when(stale, F.lit(INTERRUPTED)).otherwise(F.lit(LIVE)).alias("label"))


def as_text_map(latest: DataFrame) -> DataFrame:
    """Each row as a map of strings, booleans as "0" / "1" (a key-value store's hash)."""
    pairs = []
    for field in EVENT_SCHEMA:
        value = F.col(field.name)
        if field.dataType.typeName() == "boolean":
            value = value.cast("int")
        pairs += [F.lit(field.name), value.cast("string")]
    return latest.select(F.create_map(*pairs).alias("fields"))


def retype(maps: DataFrame) -> DataFrame:
    """Back from strings to the typed 16 fields."""
    columns = []
    for field in EVENT_SCHEMA:
        text = F.try_element_at(F.col("fields"), F.lit(field.name))
        if field.dataType.typeName() == "boolean":
            columns.append((text.cast("int") != 0).alias(field.name))
        else:
            columns.append(text.cast(field.dataType).alias(field.name))
    return maps.select(*columns)
