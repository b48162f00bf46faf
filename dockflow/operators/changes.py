"""Change detection: each reading against the station's previous one.

A window per station would put a station that holds most of the readings into one task. So
every station is cut into chunks of CHUNK_SECONDS, which are the keys of the one shuffle of the readings: a station's
day lies in many tasks. Within a chunk each reading meets its predecessor in a window. The first reading of a chunk meets the
last one of the chunk before in a second window over first and last readings only, a few hundredths of the rows where
stations are polled every minute. Both windows read the same shuffle, so the source is read and parsed once.
"""

from pyspark.sql import DataFrame, Window, functions as F

from dockflow.operators.readings import counters, describe
from dockflow.schemas import TRACKED_FIELDS

CHUNK_SECONDS = 3600
ORDER = ["ts", "offset"]


def detect_changes(readings: DataFrame, previous: DataFrame | None = None,
                   partitions: int | None = None) -> DataFrame:
    """Events: a station's first reading, and each one whose tracked fields differ.

    `bikes_delta` is the difference in bikes to the previous reading, 0 for a
    first one. `previous` holds the last reading per station of earlier runs.
    `partitions` sizes the shuffle of the readings (`session.shuffle_partitions`); without it
    the session's setting holds. All other columns are kept as they are.
    """
    keys = ["station_id", "_chunk"]
    chunked = readings.withColumn("_chunk", F.floor(F.col("ts") / CHUNK_SECONDS).cast("bigint"))
    # Spelled out, because rows that come out of a join already partitioned by station would pass the
    # window's own requirement, and a station's chunks would stay together.
    dealt = chunked.repartition(partitions, *keys) if partitions else chunked.repartition(*keys)
    tracked = F.struct(*TRACKED_FIELDS)
    in_chunk = Window.partitionBy(*keys).orderBy(*ORDER)
    compared = dealt.withColumns({
        "_now": tracked, "_before": F.lag(tracked).over(in_chunk), "_place": F.row_number().over(in_chunk),
        "_last": F.lead(F.lit(True), 1, False).over(in_chunk) == F.lit(False)})
    changed = ~F.col("_before").eqNullSafe(F.col("_now"))
    within = compared.where((F.col("_place") > 1) & changed)

    edges = compared.where((F.col("_place") == 1) | F.col("_last")).select(
        *compared.columns, F.lit(False).alias("_seed"))
    if previous is not None:
        seeds = previous.select("station_id", tracked.alias("_now"), F.lit(True).alias("_seed"))
        edges = edges.unionByName(seeds, allowMissingColumns=True)
    in_station = Window.partitionBy("station_id").orderBy(F.desc("_seed"), *ORDER)
    met = edges.withColumn("_before", F.lag("_now").over(in_station))
    firsts = met.where(~F.col("_seed") & (F.col("_place") == 1) & changed)

    delta = F.when(F.col("_before").isNull(), F.lit(0)).otherwise(
        F.col("bikes_available") - F.col("_before.bikes_available"))
    return within.unionByName(firsts.select(*within.columns)).select(*readings.columns, delta.alias("bikes_delta"))


def changes_of(status: DataFrame, info: DataFrame, previous: DataFrame | None = None,
               partitions: int | None = None) -> DataFrame:
    """Change events with their station's context, from status entries.

    Stations without information are dropped first by their id alone, and names
    and places are joined to the emitted events only, so the shuffle of the
    readings carries nothing but counters. The context is fixed per station, so
    the result is that of detecting on fully joined readings.
    """
    known = counters(status).join(info.select("station_id"), "station_id", "left_semi")
    return describe(detect_changes(known, previous, partitions), info)
