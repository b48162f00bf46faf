"""Numbers 0, 1, 2 ... for all rows, or for the rows of each group, without a single large task."""

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from dockflow.llm.common import same


def spread(key: list[str], buckets: int) -> Column:
    """Bucket of a row from the md5 of its key; nulls count as a text of their own."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in key]
    digest = F.md5(F.concat_ws("\x1f", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % buckets


def numbered(df: DataFrame, key: list[str], rows: int, group: list[str] | None = None,
             ties: list[str] | None = None, lead: list[str] | None = None, out: str = "row") -> DataFrame:
    """Add `out`, the row's number within its group, from 0 without gaps.

    The order is (lead, md5 bucket of key and ties, key, ties), nulls first, so it does not depend on
    files or tasks. Rows that agree in key and ties are interchangeable, those of one key with unlike ties lie
    in many buckets. `rows` is the number
    of rows of df; there are about sqrt(rows) buckets of about sqrt(rows) rows, sorted each on
    its own, and a table of (group, bucket) counts gives each bucket its first number. A hot
    group is spread over as many buckets as the whole table.
    """
    group, lead = group or [], lead or []
    buckets = max(1, math.isqrt(max(rows - 1, 0)) + 1)
    placed = df.withColumn("_bucket", spread([*key, *(ties or [])], buckets))
    cells = placed.groupBy(*group, *lead, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group or [F.lit(0)]).orderBy(*lead, "_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    first = cells.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    order = [F.col(c).asc_nulls_first() for c in [*key, *(ties or [])]]
    within = F.row_number().over(Window.partitionBy(*group, *lead, "_bucket").orderBy(*order))
    ranked = placed.withColumn("_within", within)
    columns = [ranked[c] for c in df.columns]
    return (ranked.join(first, same(ranked, first, [*group, *lead, "_bucket"]))
            .select(*columns, (first["_first"] + ranked["_within"] - 1).cast("long").alias(out)))
