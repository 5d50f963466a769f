"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mktlens.functions._util import col_of

# The characters removed by ``trim_ws``. Spark's plain ``trim``
# strips only U+0020; the warehouse semantics strip every Unicode white-space
# character, listed here in code-point order.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trim_ws(c: str | Column) -> Column:
    """Strip leading and trailing Unicode white space (stays in codegen)."""
    return F.trim(col_of(c), F.lit(WHITESPACE))


def clean_text(c: str | Column) -> Column:
    """``LOWER(TRIM(x))``: the normalisation applied to every category-like field."""
    return F.lower(trim_ws(c))


def blank_to(c: str | Column, default: str) -> Column:
    """``COALESCE(NULLIF(LOWER(TRIM(x)), ''), default)``."""
    return F.coalesce(F.nullif(clean_text(c), F.lit("")), F.lit(default))
