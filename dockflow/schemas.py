"""Schemas of the documents, tables and views (the contract between jobs)."""

from pyspark.sql import types as T

# --- change events: the 16 wire fields, in wire order (fixed values) ---------
EVENT_SCHEMA = T.StructType([
    T.StructField("station_id", T.LongType()),
    T.StructField("station_code", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("capacity", T.IntegerType()),
    T.StructField("ts", T.LongType()),
    T.StructField("last_reported", T.LongType()),
    T.StructField("mechanical", T.IntegerType()),
    T.StructField("ebike", T.IntegerType()),
    T.StructField("bikes_available", T.IntegerType()),
    T.StructField("docks_available", T.IntegerType()),
    T.StructField("is_installed", T.BooleanType()),
    T.StructField("is_renting", T.BooleanType()),
    T.StructField("is_returning", T.BooleanType()),
    T.StructField("bikes_delta", T.IntegerType()),
])
EVENT_FIELDS = EVENT_SCHEMA.fieldNames()
READING_FIELDS = [f for f in EVENT_FIELDS if f != "bikes_delta"]

# The fields whose change makes a new event (fixed values); timestamps are left out on purpose.
TRACKED_FIELDS = [
    "mechanical", "ebike", "bikes_available", "docks_available",
    "is_installed", "is_renting", "is_returning",
]

# Record metadata that travels beside the event in the log.
RECORD_FIELDS = ["offset", "publish_ts"]

READING_SCHEMA = T.StructType(
    [EVENT_SCHEMA[f] for f in READING_FIELDS]
    + [T.StructField("offset", T.LongType()), T.StructField("publish_ts", T.LongType())]
)

# The moving part of a reading: what change detection compares and shuffles.
COUNTER_FIELDS = ["station_id", "ts", "last_reported", *TRACKED_FIELDS, *RECORD_FIELDS]
COUNTER_SCHEMA = T.StructType([READING_SCHEMA[f] for f in COUNTER_FIELDS])

# --- source documents ---------------------------------------------------------
INFORMATION_SCHEMA = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("stations", T.ArrayType(T.StructType([
            T.StructField("station_id", T.LongType()),
            T.StructField("stationCode", T.StringType()),
            T.StructField("name", T.StringType()),
            T.StructField("lat", T.DoubleType()),
            T.StructField("lon", T.DoubleType()),
            T.StructField("capacity", T.IntegerType()),
        ]))),
    ])),
])

STATUS_SCHEMA = T.StructType([
    T.StructField("lastUpdatedOther", T.LongType()),
    T.StructField("ttl", T.IntegerType()),
    T.StructField("data", T.StructType([
        T.StructField("stations", T.ArrayType(T.StructType([
            T.StructField("station_id", T.LongType()),
            T.StructField("num_bikes_available", T.IntegerType()),
            T.StructField("num_bikes_available_types",
                          T.ArrayType(T.MapType(T.StringType(), T.IntegerType()))),
            T.StructField("num_docks_available", T.IntegerType()),
            T.StructField("is_installed", T.IntegerType()),
            T.StructField("is_renting", T.IntegerType()),
            T.StructField("is_returning", T.IntegerType()),
            T.StructField("last_reported", T.LongType()),
        ]))),
    ])),
])

WEATHER_DOCUMENT_SCHEMA = T.StructType([
    T.StructField("hourly", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("precipitation", T.ArrayType(T.DoubleType())),
        T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
        T.StructField("wind_speed_10m", T.ArrayType(T.DoubleType())),
        T.StructField("relative_humidity_2m", T.ArrayType(T.IntegerType())),
        T.StructField("weather_code", T.ArrayType(T.IntegerType())),
    ])),
])

# A district feature; the coordinates stay JSON text because their nesting
# depends on the geometry type.
FEATURE_SCHEMA = T.StructType([
    T.StructField("properties", T.StructType([T.StructField("arr", T.IntegerType())])),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.StringType()),
    ])),
])

# --- log records (the shape of a Kafka source) --------------------------------
LOG_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("publish_ts", T.LongType()),
])

# --- archives: column types at rest (fixed values) ------------------------------------------
ARCHIVE_EVENT_TYPES = {
    "ts": "bigint", "hour": "tinyint", "station_id": "bigint", "station_code": "string",
    "name": "string", "lat": "double", "lon": "double", "capacity": "smallint",
    "last_reported": "bigint", "mechanical": "smallint", "ebike": "smallint",
    "bikes_available": "smallint", "docks_available": "smallint", "is_installed": "boolean",
    "is_renting": "boolean", "is_returning": "boolean", "bikes_delta": "smallint",
}
ARCHIVE_WEATHER_TYPES = {
    "ts": "bigint", "hour": "tinyint", "precipitation": "double", "temperature": "double",
    "wind_speed": "double", "humidity": "double", "weather_code": "smallint",
}


HOURS_TYPES = {"hour": "tinyint", "events": "bigint", "taken": "bigint", "returned": "bigint"}  # sums of a date's hour


def ddl(types: dict[str, str]) -> str:
    """Archive schema as DDL, with the `date` partition column last."""
    return ", ".join(f"{name} {kind}" for name, kind in types.items()) + ", date date"


def _ddl_of(schema: T.StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


# --- derived tables and views ---------------------------------------------------
EVENT_DDL = _ddl_of(EVENT_SCHEMA)
RECORD_DDL = f"{EVENT_DDL}, offset bigint, publish_ts bigint"
LOG_DDL = _ddl_of(LOG_SCHEMA)
LOG_TABLE_DDL = f"{LOG_DDL}, date date, batch_id bigint"  # a log that jobs here wrote
REJECTED_POLLS_DDL = "value string"
REJECTED_DDL = f"{LOG_DDL}, reason string"
COUNTER_DDL = _ddl_of(COUNTER_SCHEMA)
MINUTES_DDL = "t bigint, events bigint, taken bigint, returned bigint"
FLOWS_DDL = "station_id bigint, taken bigint, returned bigint"
