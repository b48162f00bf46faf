"""Station search by name."""

import unicodedata

from pyspark.sql import DataFrame, functions as F

from dockflow.functions import station

MIN_LENGTH = 2
SUBURB = "banlieue"  # fixed value


def _plain(text: str) -> str:
    decomposed = unicodedata.normalize("NFD", text.strip())
    return "".join(c for c in decomposed if not unicodedata.combining(c)).lower()


def station_search(latest: DataFrame, query: str, mode: str = "bikes", n: int = 8) -> DataFrame:
    """Stations whose name starts with the query, then those that contain it.

    Accents and case do not matter; queries below two characters find nothing.
    """
    wanted = _plain(query)
    name, text = station.folded(F.col("name")), F.lit(wanted)
    rank = F.when(F.startswith(name, text), 0).when(F.contains(name, text), 1)
    found = latest.withColumn("rank", rank).where(
        F.col("rank").isNotNull() & F.lit(len(wanted) >= MIN_LENGTH))
    arr = station.district(F.col("station_code"))
    place = F.coalesce(F.concat(arr.cast("string"), F.lit("ᵉ arr.")), F.lit(SUBURB))
    return found.orderBy("rank", "station_id").limit(n).select(
        "rank", "station_id", "name", place.alias("place"),
        station.mode_count(mode).alias("count"), "lat", "lon")
