"""Money and exact rounding expressions.

Every rounded ratio in the marts is a quotient of two integers (counts, day
sums, money in cents). Rounding the double ``a / b`` is not portable: engines
disagree at ties (one rounds the decimal string, another the binary value),
and a summation order change moves the last bits. ``rounded_quotient`` rounds
the exact rational ``a / b`` half away from zero with integer arithmetic only,
so the result is the same on every engine and every partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mktlens.functions._util import col_of

MONEY = "decimal(18,2)"


def money(c: str | Column) -> Column:
    """``CAST(x AS NUMERIC)`` for currency: exact cents, half-up."""
    return col_of(c).cast(MONEY)


def cents(c: str | Column) -> Column:
    """A money (or 2-dp) value as an exact integer number of hundredths."""
    return F.round(col_of(c) * 100, 0).cast("bigint")


def money_sum(c: str | Column) -> Column:
    """``SUM`` of a 2-dp money column, exact, as ``decimal(38,2)``.

    The aggregation buffer is a primitive long of cents rather than a decimal,
    which keeps the partial aggregate cheap; the total is converted back once.
    A long of cents overflows only beyond 9.2e16 currency units (and ANSI
    mode raises rather than wraps).
    """
    total = F.sum((col_of(c) * 100).cast("bigint"))
    return (total.cast("decimal(38,0)") / F.lit(100)).cast("decimal(38,2)")


def _idiv(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def rounded_quotient(num: str | Column, den: str | Column, digits: int = 2, times: int = 1) -> Column:
    """``ROUND(times * SAFE_DIVIDE(num, den), digits)`` computed exactly.

    ``num`` and ``den`` are integer-valued, ``den >= 0``; NULL when ``den`` is
    0 or NULL, like ``SAFE_DIVIDE``. Returns a double. The whole part is taken
    first; only the remainder, which is below ``den``, is scaled, as a decimal
    of 38 digits, so nothing overflows while the quotient itself is a bigint.
    """
    n = col_of(num).cast("bigint")
    d = col_of(den).cast("bigint")
    scale = 10**digits
    # as decimals: abs() of the least bigint is no bigint
    wide = F.abs(n.cast("decimal(20,0)"))
    whole = _idiv(wide, d)
    rest = (wide - whole * d).cast("decimal(20,0)")
    part = _idiv(rest * F.lit(2 * scale * times) + d, d.cast("decimal(20,0)") * 2)
    total = (whole.cast("decimal(20,0)") * F.lit(scale * times)).cast("decimal(38,0)") + part
    return F.when(d > 0, F.signum(n) * total.cast("double") / F.lit(float(scale)))


def pct(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    """``ROUND(SAFE_DIVIDE(num, den) * 100, digits)`` for integer counts."""
    return rounded_quotient(num, den, digits, times=100)


def avg_rounded(c: str | Column, digits: int = 2) -> Column:
    """``ROUND(AVG(x), digits)`` for an integer-valued column (aggregate)."""
    x = col_of(c)
    return rounded_quotient(F.sum(x), F.count(x), digits)


def avg_rounded_hundredths(c: str | Column, digits: int = 2) -> Column:
    """``ROUND(AVG(x), digits)`` for a column that already holds 2-dp values.

    The values are summed as exact hundredths, so the average does not depend
    on the order in which partial sums are merged.
    """
    h = cents(c)
    return rounded_quotient(F.sum(h), F.count(h) * 100, digits)


def round_double(c: str | Column, digits: int = 2) -> Column:
    """``ROUND(x, digits)`` for a genuinely fractional double.

    The value is first fixed to 12 decimals so the half-way test is done on
    the decimal form, not on binary noise from summation order.
    """
    return F.round(col_of(c).cast("decimal(38,12)"), digits).cast("double")
