"""Delivery classification expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mktlens.functions._util import col_of
from mktlens.functions.dates import day_of, days_between

# Labels and cut-offs of the two delivery classifications.
NOT_DELIVERED = "not_delivered"
ON_TIME = "on_time"
LATE = "late"
ON_TIME_OR_EARLY = "on_time_or_early"
LATE_1_3 = "late_1_3_days"
LATE_4_7 = "late_4_7_days"
LATE_8_PLUS = "late_8_plus_days"
DELAY_CUTOFFS = (3, 7)


def delivery_status(delivered: str | Column, estimated: str | Column) -> Column:
    """Timestamp comparison: ``not_delivered`` / ``on_time`` / ``late``.

    A delivered order with a NULL estimate falls through to ``late``.
    """
    d, e = col_of(delivered), col_of(estimated)
    return (
        F.when(d.isNull(), F.lit(NOT_DELIVERED))
        .when(d <= e, F.lit(ON_TIME))
        .otherwise(F.lit(LATE))
    )


def delivery_delay_days(delivered: str | Column, estimated: str | Column) -> Column:
    """Calendar days between estimated and actual delivery dates."""
    return days_between(day_of(delivered), day_of(estimated))


def delay_bucket(delivered: str | Column, estimated: str | Column) -> Column:
    """Date comparison into five buckets with cut-offs at 3 and 7 days late."""
    d, e = col_of(delivered), col_of(estimated)
    delay = delivery_delay_days(d, e)
    short, medium = DELAY_CUTOFFS
    return (
        F.when(d.isNull(), F.lit(NOT_DELIVERED))
        .when(day_of(d) <= day_of(e), F.lit(ON_TIME_OR_EARLY))
        .when(delay <= short, F.lit(LATE_1_3))
        .when(delay <= medium, F.lit(LATE_4_7))
        .otherwise(F.lit(LATE_8_PLUS))
    )
