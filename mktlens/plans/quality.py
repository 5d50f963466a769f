"""Quality gate: fan-out and KPI reconciliation across layers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mktlens.operators import check_summary, comparison_table, scalar

# Value types of the two comparison tables: money-capable exact decimals for
# the fan-out checks, integers for the KPI checks.
FANOUT_TYPE = "decimal(38,2)"
KPI_TYPE = "bigint"


def _one_pass(df: DataFrame, **aggs: F.Column) -> dict[str, F.Column]:
    """Several aggregates of one table from a single scan: one scalar
    subquery returning a struct, unpacked into named columns."""
    s = scalar(df, F.struct(*[a.alias(k) for k, a in aggs.items()]))
    return {k: s.getField(k) for k in aggs}


def join_fanout_reconciliation(
    stg_orders: DataFrame, stg_items: DataFrame, stg_payments: DataFrame, m1: DataFrame, m2: DataFrame
) -> DataFrame:
    """Six source-vs-model totals that a row-multiplying join would break.
    Each table is aggregated once."""
    items = _one_pass(stg_items, price=F.sum("item_price"), freight=F.sum("freight_value"))
    mo = _one_pass(
        m1,
        rows=F.count("*"),
        price=F.sum("product_value"),
        freight=F.sum("freight_value"),
        paid=F.sum("payment_value"),
    )
    mos = _one_pass(m2, price=F.sum("product_value"), freight=F.sum("freight_value"))
    metrics = [
        ("order_row_count", scalar(stg_orders, F.count("*")), mo["rows"]),
        ("order_product_value", items["price"], mo["price"]),
        ("order_freight_value", items["freight"], mo["freight"]),
        ("order_payment_value", scalar(stg_payments, F.sum("payment_value")), mo["paid"]),
        ("order_seller_product_value", items["price"], mos["price"]),
        ("order_seller_freight_value", items["freight"], mos["freight"]),
    ]
    return comparison_table(stg_orders, metrics, FANOUT_TYPE)


# Columns whose totals the fan-out checks compare, by view.
FANOUT_MEASURES = {
    "stg_order_items": ("item_price", "freight_value"),
    "stg_order_payments": ("payment_value",),
    "mart_orders": ("product_value", "freight_value", "payment_value"),
    "mart_order_seller": ("product_value", "freight_value"),
}


def fanout_of_totals(spark: SparkSession, totals: Mapping[str, Mapping]) -> DataFrame:
    """``join_fanout_reconciliation`` from totals known already: for every view
    its ``rows`` and the sums of its ``FANOUT_MEASURES``."""
    of = lambda view, what: F.lit(totals[view][what])
    items, m1, m2 = "stg_order_items", "mart_orders", "mart_order_seller"
    metrics = [
        ("order_row_count", of("stg_orders", "rows"), of(m1, "rows")),
        ("order_product_value", of(items, "item_price"), of(m1, "product_value")),
        ("order_freight_value", of(items, "freight_value"), of(m1, "freight_value")),
        ("order_payment_value", of("stg_order_payments", "payment_value"), of(m1, "payment_value")),
        ("order_seller_product_value", of(items, "item_price"), of(m2, "product_value")),
        ("order_seller_freight_value", of(items, "freight_value"), of(m2, "freight_value")),
    ]
    return comparison_table(spark.range(1), metrics, FANOUT_TYPE)


def final_kpi_validation(
    raw_orders: DataFrame,
    raw_leads: DataFrame,
    raw_deals: DataFrame,
    raw_sellers: DataFrame,
    raw_reviews: DataFrame,
    m1: DataFrame,
    m2: DataFrame,
    m3: DataFrame,
    m4: DataFrame,
    a1: DataFrame,
    a3: DataFrame,
) -> DataFrame:
    """Six headline KPIs recomputed from raw tables and from marts/analyses."""
    count = F.count("*")
    life = _one_pass(m4, rows=count, activated=F.count_if(F.col("is_activated")))
    metrics = [
        ("total_orders", scalar(raw_orders, count), scalar(m1, count)),
        ("total_marketing_leads", scalar(raw_leads, count), scalar(m3, F.sum("total_leads"))),
        ("closed_leads", scalar(raw_deals, count), life["rows"]),
        ("activated_sellers", life["activated"], scalar(a1, F.sum("activated_sellers"))),
        ("marketplace_sellers", scalar(raw_sellers, count), scalar(m2, F.count_distinct("seller_id"))),
        (
            "reviewed_orders",
            scalar(raw_reviews, F.count_distinct("order_id")),
            scalar(a3, F.sum("reviewed_order_count")),
        ),
    ]
    return comparison_table(raw_orders, metrics, KPI_TYPE, model_label="final_value")


def fanout_summary(q1: DataFrame) -> DataFrame:
    return check_summary(q1)


def kpi_summary(q2: DataFrame) -> DataFrame:
    return check_summary(q2)
