"""Totals of what follows a point in time, without pairing points with days.

For points (key, at) and daily rows (key, day, measures) a join on
``day >= at`` meets every point with every later day of its key. Here both are
put in one list per key, last day first, and a running sum over it gives each
point the totals of all days from it on: one sort, one pass, as many rows as
points and days together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def totals_from(
    points: DataFrame, daily: DataFrame, key: str, at: str, day: str, sums: Sequence[str], least: bool = True
) -> DataFrame:
    """``points`` plus, over the daily rows of the same key with day >= at:
    the sum of each column of ``sums`` and ``first_day``; with ``least`` also
    ``least_day``, the key's first day of all. NULL where there is no such row,
    and for a point without a key; a point without a time has no following days.
    The rows of a key take one pass in order of time, on disk if they are many.

    ``daily`` has at most one row per key and day; rows without either are
    left out. Columns of ``points`` are kept in one struct meanwhile.
    """
    rows = daily.where(F.col(key).isNotNull() & F.col(day).isNotNull()).select(
        F.col(key).alias("_key"), F.col(day).alias("_at"), F.col(day).alias("_day"), *[F.col(c).alias(f"_{c}") for c in sums]
    )
    keyed = points.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col(at).alias("_at"), F.struct(*points.columns).alias("_point")
    )
    both = rows.unionByName(keyed, allowMissingColumns=True)
    # Days before points: a day of the very time counts as following it.
    order = [F.col("_at").desc_nulls_last(), F.col("_point").isNotNull().asc()]
    upto = Window.partitionBy("_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    timed = F.col("_at").isNotNull()
    seen = both.select(
        "_point",
        *[F.when(timed, F.sum(f"_{c}").over(upto)).alias(c) for c in sums],
        F.when(timed, F.min("_day").over(upto)).alias("first_day"),
        "_key",
    ).where(F.col("_point").isNotNull())
    shown = ["first_day"]
    if least:
        days = rows.groupBy(F.col("_key").alias("_of")).agg(F.min("_day").alias("least_day"))
        seen = seen.join(days, F.col("_key") == F.col("_of"), "left")
        shown.append("least_day")
    out = seen.select("_point.*", *sums, *shown)
    keyless = points.where(F.col(key).isNull())
    return out.unionByName(keyless, allowMissingColumns=True)
