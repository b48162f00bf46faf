"""Column rules of a station row."""

from pyspark.sql import Column, functions as F

from dockflow.functions.numbers import half_up

MODES = ("bikes", "docks")

# The status texts of the station card.
STATUS_OUT = "⛔ Hors service"
STATUS_CLOSED = "⛔ Fermée (ni location ni retour)"
STATUS_NO_RENTING = "⚠️ Location suspendue"
STATUS_NO_RETURNING = "⚠️ Retour suspendu"
STATUS_OK = "✅ En service"

# States of the rebalancing list.
STATE_EMPTY = "vide"
STATE_FULL = "pleine"


def bike_types(types: Column) -> Column:
    """Flatten [{"mechanical": 3}, {"ebike": 2}] to a struct of two counts.

    Order does not matter, a missing key or list counts 0, the last object
    wins when a key is repeated.
    """
    keys = ("mechanical", "ebike")
    none = F.struct(*[F.lit(0).alias(k) for k in keys])

    def merge(counts: Column, entry: Column) -> Column:
        return F.struct(*[
            F.coalesce(F.try_element_at(entry, F.lit(k)), counts[k]).alias(k) for k in keys])

    return F.coalesce(F.aggregate(types, none, merge), none)


def flag(value: Column) -> Column:
    """0/1 on the wire to boolean; missing is false, any other number true."""
    return F.coalesce(value, F.lit(0)) != 0


def taken(delta: Column) -> Column:
    return F.greatest(-F.coalesce(delta, F.lit(0)), F.lit(0))


def returned(delta: Column) -> Column:
    return F.greatest(F.coalesce(delta, F.lit(0)), F.lit(0))


def district(code: Column) -> Column:
    """District 1 to 20 from the code prefix; null for suburbs and broken codes."""
    number = code.try_cast("bigint")
    return F.when(number.between(1000, 20999), F.floor(number / 1000).cast("int"))


def is_empty() -> Column:
    return F.col("is_installed") & F.col("is_renting") & (F.col("bikes_available") == 0)


def is_full() -> Column:
    return F.col("is_installed") & F.col("is_returning") & (F.col("docks_available") == 0)


def is_out_of_order() -> Column:
    return ~F.col("is_installed") | ~(F.col("is_renting") | F.col("is_returning"))


def is_open() -> Column:
    return F.col("is_installed") & F.col("is_renting")


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    return mode


def mode_count(mode: str) -> Column:
    """What the chosen mode counts at a station: bikes or free docks."""
    return F.col("bikes_available" if check_mode(mode) == "bikes" else "docks_available")


def is_closed(mode: str) -> Column:
    serving = F.col("is_renting" if check_mode(mode) == "bikes" else "is_returning")
    return ~F.col("is_installed") | ~serving


def fill_level(count: Column, capacity: Column, no_capacity: float) -> Column:
    """critical at 0, else the quarter the fill ratio lies in (level0 to level3)."""
    share = F.when(capacity > 0, count / capacity).otherwise(F.lit(no_capacity))
    level = F.least(F.lit(3), F.floor(share * 4).cast("int"))
    return F.when(count == 0, F.lit("critical")).otherwise(
        F.concat(F.lit("level"), level.cast("string")))


def fill_class(mode: str) -> Column:
    """Display class of a station in a mode; without capacity it counts as full."""
    return F.when(is_closed(mode), F.lit("closed")).otherwise(
        fill_level(mode_count(mode), F.col("capacity"), 1.0))


def fill_percent() -> Column:
    """Bikes per capacity in percent, 0 without capacity."""
    return F.when(F.col("capacity") != 0,
                  F.lit(100.0) * F.col("bikes_available") / F.col("capacity")).otherwise(F.lit(0.0))


def status_label() -> Column:
    installed, renting, returning = (
        F.col(c) for c in ("is_installed", "is_renting", "is_returning"))
    return (
        F.when(~installed, F.lit(STATUS_OUT))
        .when(~renting & ~returning, F.lit(STATUS_CLOSED))
        .when(~renting, F.lit(STATUS_NO_RENTING))
        .when(~returning, F.lit(STATUS_NO_RETURNING))
        .otherwise(F.lit(STATUS_OK))
    )


def grid_cell(coordinate: Column, size: float = 0.03) -> Column:
    """Number of the map cell along one axis."""
    return half_up(coordinate / F.lit(size))


def display_name(name: Column, station_id: Column) -> Column:
    """The name, or the id as text where there is none."""
    return F.coalesce(F.nullif(name, F.lit("")), station_id.cast("string"))


def folded(text: Column) -> Column:
    """Text that compares without regard to accents and case."""
    return F.collate(text, "UNICODE_CI_AI")
