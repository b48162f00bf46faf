"""Rounding and number labels with the page script's rules."""

from pyspark.sql import Column, functions as F


def half_up(x: Column) -> Column:
    """Round half towards plus infinity, as a whole number."""
    return F.floor(x + F.lit(0.5)).cast("bigint")


def fixed(x: Column, digits: int, point: str = ",") -> Column:
    """Decimal text of a non-negative double with 1 or 2 digits.

    Rounds on the exact binary value of the double, ties upwards. The SQL
    formatters round its shortest decimal form instead (0.35 and 16.35 come out
    differently), hence the exact arithmetic on the fraction times 2^61.
    """
    def exact(n: int) -> Column:
        return F.lit(n).cast("decimal(20,0)")

    scale = 10 ** digits
    fraction = F.floor((x - F.floor(x)) * F.lit(2.0 ** 61)).cast("bigint").cast("decimal(20,0)")
    part = F.call_function("div", fraction * exact(2 * scale) + exact(2 ** 61), exact(2 ** 62))
    total = F.floor(x).cast("bigint") * scale + part
    return F.format_string(
        f"%d{point}%0{digits}d", F.call_function("div", total, F.lit(scale)),
        F.pmod(total, F.lit(scale)))


def percent_label(ratio: Column) -> Column:
    """Ratio as a percentage with one decimal and a comma."""
    return F.concat(fixed(F.lit(100.0) * ratio, 1), F.lit(" %"))


GROUPING = "\u202f"  # fixed value: French groups of thousands


def grouped(n: Column) -> Column:
    """Whole number with groups of three digits."""
    return F.replace(F.format_number(n.cast("bigint"), 0), F.lit(","), F.lit(GROUPING))


def signed_label(n: Column) -> Column:
    """`+n` above zero, else the plain number, grouped; missing counts as 0."""
    value = F.coalesce(n, F.lit(0))
    return F.concat(F.when(value > 0, F.lit("+")).otherwise(F.lit("")), grouped(value))


def ratio(part: Column, whole: Column, otherwise=None) -> Column:
    """part / whole as a double, `otherwise` where the whole is 0."""
    return F.when(whole != 0, part.cast("double") / whole).otherwise(
        F.lit(otherwise).cast("double")
    )


def age_label(seconds: Column) -> Column:
    """Age as seconds, minutes or hours."""
    return (
        F.when(seconds < 60, F.concat(F.greatest(F.lit(0), half_up(seconds)).cast("string"),
                                      F.lit(" s")))
        .when(seconds < 3600, F.concat(half_up(seconds / 60).cast("string"), F.lit(" min")))
        .otherwise(F.concat(half_up(seconds / 3600).cast("string"), F.lit(" h")))
    )
