"""Shared column expressions (all JVM-side built-ins, no UDFs)."""

from mktlens.functions.agg import count_where, string_set_agg
from mktlens.functions.dates import day_of, days_between, month_of
from mktlens.functions.numeric import (
    MONEY,
    avg_rounded,
    avg_rounded_hundredths,
    cents,
    money,
    money_sum,
    pct,
    round_double,
    rounded_quotient,
)
from mktlens.functions.status import delay_bucket, delivery_delay_days, delivery_status
from mktlens.functions.text import WHITESPACE, blank_to, clean_text, trim_ws

__all__ = [
    "MONEY",
    "WHITESPACE",
    "avg_rounded",
    "avg_rounded_hundredths",
    "blank_to",
    "cents",
    "clean_text",
    "count_where",
    "day_of",
    "days_between",
    "delay_bucket",
    "delivery_delay_days",
    "delivery_status",
    "money",
    "money_sum",
    "month_of",
    "pct",
    "round_double",
    "rounded_quotient",
    "string_set_agg",
    "trim_ws",
]
