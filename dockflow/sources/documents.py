"""Station, status, weather and district documents to rows.

Each scan takes documents that are already columns, so the same code serves
JSON files, JSON text in a column, and a file stream.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from dockflow import schemas
from dockflow.functions.clock import DEFAULT_TZ, epoch_seconds, local_hour, utc_date

BBOX_MARGIN = 0.005


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON documents, one per file, with their `arrival`; a broken file gives a row of nulls."""
    docs = spark.read.schema(schema).option("multiLine", True).json(path)
    return docs.withColumn("arrival", F.struct(
        F.col("_metadata.file_modification_time").alias("time"),
        F.col("_metadata.file_path").alias("path")))


def split_documents(files: DataFrame, text: str = "value") -> DataFrame:
    """Text of whole files to one row per document, indented or one per line.

    A document begins where a line starts with a brace and the line before ended with one.
    """
    parts = F.split(F.trim(F.col(text)), r"(?<=\})[ \t]*\r?\n(?=\{)")
    return files.select(F.explode(parts).alias(text)).where(F.trim(text) != "")


def parse_documents(docs: DataFrame, schema: T.StructType, text: str = "value") -> DataFrame:
    """JSON text in a column to document columns; other columns are kept.

    Parsed in a generator: as a plain projection the optimizer would parse the
    text once for every field that is used.
    """
    kept = [c for c in docs.columns if c != text]
    return docs.select(*kept, F.inline(F.array(F.from_json(text, schema))))


def _arrival(docs: DataFrame) -> Column:
    """Order of documents among each other: record offset, else the file's time and name."""
    known = [F.col(c) for c in ("offset", "arrival") if c in docs.columns]
    return F.struct(*known) if known else F.lit(0).cast("bigint")


def station_info(docs: DataFrame) -> DataFrame:
    """One row per station; missing texts are empty, missing capacity 0.

    Of several entries for a station the last one of the document that arrived last counts. `max_by` combines
    before the shuffle, so a station listed in every document stays cheap.
    An entry without id or coordinates is no station.
    """
    entries = docs.select(
        _arrival(docs).alias("doc"), F.posexplode("data.stations").alias("pos", "s")).where(
        "s.station_id IS NOT NULL AND s.lat IS NOT NULL AND s.lon IS NOT NULL")
    fields = F.struct(
        F.coalesce("s.stationCode", F.lit("")).alias("station_code"),
        F.coalesce("s.name", F.lit("")).alias("name"),
        F.col("s.lat").alias("lat"),
        F.col("s.lon").alias("lon"),
        F.coalesce("s.capacity", F.lit(0)).alias("capacity"),
    )
    last = entries.groupBy(F.col("s.station_id").alias("station_id")).agg(
        F.max_by(fields, F.struct("doc", "pos")).alias("info"))
    return last.select("station_id", "info.*")


def status_scan(docs: DataFrame) -> DataFrame:
    """One row per station entry, stamped with its document's time.

    `offset` and `publish_ts` come from the record where it has them; otherwise
    the place in the document and the document time stand in.
    """
    has = set(docs.columns)
    rows = docs.select(
        F.col("lastUpdatedOther").alias("ts"),
        *[c for c in schemas.RECORD_FIELDS if c in has],
        F.posexplode("data.stations").alias("pos", "s"),
    )
    pos, ts = F.col("pos").cast("bigint"), F.col("ts")
    offset = F.coalesce("offset", pos) if "offset" in has else pos
    publish_ts = F.coalesce("publish_ts", ts) if "publish_ts" in has else ts
    return rows.select(
        "s.station_id", "ts", "s.num_bikes_available", "s.num_bikes_available_types",
        "s.num_docks_available", "s.is_installed", "s.is_renting", "s.is_returning",
        "s.last_reported", offset.alias("offset"), publish_ts.alias("publish_ts"),
    )


def weather_hourly(docs: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """Parallel arrays to one row per hour; times are UTC, `hour` is local."""
    rows = docs.select(F.inline(F.arrays_zip(
        "hourly.time", "hourly.precipitation", "hourly.temperature_2m",
        "hourly.wind_speed_10m", "hourly.relative_humidity_2m", "hourly.weather_code")))
    timed = rows.withColumn("ts", epoch_seconds(F.col("time").cast("timestamp_ntz")))
    return timed.select(
        "ts",
        local_hour(F.col("ts"), tz).cast("tinyint").alias("hour"),
        "precipitation",
        F.col("temperature_2m").alias("temperature"),
        F.col("wind_speed_10m").alias("wind_speed"),
        F.col("relative_humidity_2m").cast("double").alias("humidity"),
        F.col("weather_code").cast("smallint").alias("weather_code"),
        utc_date(F.col("ts")).alias("date"),
    )


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """District features of a GeoJSON FeatureCollection."""
    collection = T.StructType([T.StructField("features", T.ArrayType(schemas.FEATURE_SCHEMA))])
    return read_documents(spark, path, collection).select(F.inline("features"))


def district_rings(features: DataFrame) -> DataFrame:
    """One row per ring: district id and its [lon, lat] points."""
    text, kind = F.col("geometry.coordinates"), F.col("geometry.type")
    polygon = F.from_json(text, "array<array<array<double>>>")
    multi = F.flatten(F.from_json(text, "array<array<array<array<double>>>>"))
    rings = F.when(kind == "Polygon", polygon).when(kind == "MultiPolygon", multi)
    return features.select(F.col("properties.arr").alias("arr"), F.explode(rings).alias("ring"))


def geo_bbox(features: DataFrame, margin: float = BBOX_MARGIN) -> DataFrame:
    """Bounding box over all points of all rings, widened by a margin."""
    points = district_rings(features).select(F.explode("ring").alias("p"))
    lon, lat = F.col("p")[0], F.col("p")[1]
    return points.agg(
        (F.min(lon) - F.lit(margin)).alias("min_lon"),
        (F.max(lon) + F.lit(margin)).alias("max_lon"),
        (F.min(lat) - F.lit(margin)).alias("min_lat"),
        (F.max(lat) + F.lit(margin)).alias("max_lat"),
    )
