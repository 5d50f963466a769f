"""Date expressions with warehouse semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mktlens.functions._util import col_of


def day_of(c: str | Column) -> Column:
    """``DATE(ts)``."""
    return F.to_date(col_of(c))


def month_of(c: str | Column) -> Column:
    """``DATE_TRUNC(DATE(x), MONTH)`` returning a DATE."""
    return F.trunc(F.to_date(col_of(c)), "month")


def days_between(end: str | Column, start: str | Column) -> Column:
    """``DATE_DIFF(end, start, DAY)`` on DATE values, as BIGINT."""
    return F.datediff(col_of(end), col_of(start)).cast("bigint")
