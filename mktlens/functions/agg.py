"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mktlens.functions._util import col_of


def string_set_agg(c: str | Column, sep: str = ", ") -> Column:
    """``STRING_AGG(DISTINCT x, sep ORDER BY x)``; NULL when no non-null value.

    ``collect_set`` is partially aggregated map-side, so a hot group only
    ships its distinct values (a small domain: payment types, categories).
    """
    s = F.collect_set(col_of(c))
    return F.when(F.size(s) > 0, F.array_join(F.array_sort(s), sep))


def count_where(pred: Column) -> Column:
    """``COUNTIF(pred)`` as BIGINT."""
    return F.count_if(pred).cast("bigint")
