"""Staging views: typed, cleaned, one row per source key.

All four are narrow projections with filters; Catalyst pushes the NOT NULL
and range predicates into the parquet scan and prunes unused columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktlens.functions import clean_text, count_where, day_of, days_between, money, month_of, pct, blank_to


def stg_orders(orders: DataFrame) -> DataFrame:
    """Grain: order_id. Normalised status, purchase date and month."""
    return orders.where(F.col("order_id").isNotNull() & F.col("customer_id").isNotNull()).select(
        "order_id",
        "customer_id",
        clean_text("order_status").alias("order_status"),
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        day_of("order_purchase_timestamp").alias("purchase_date"),
        month_of("order_purchase_timestamp").alias("purchase_month"),
    )


def stg_order_items(items: DataFrame) -> DataFrame:
    """Grain: (order_id, order_item_id). Exact money; negative values dropped."""
    return items.where(
        F.col("order_id").isNotNull()
        & F.col("order_item_id").isNotNull()
        & F.col("product_id").isNotNull()
        & F.col("seller_id").isNotNull()
        & (F.col("price") >= 0)
        & (F.col("freight_value") >= 0)
    ).select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        money("price").alias("item_price"),
        money("freight_value").alias("freight_value"),
        (money("price") + money("freight_value")).alias("item_total_value"),
    )


def stg_order_payments(payments: DataFrame) -> DataFrame:
    """Grain: (order_id, payment_sequential).

    Card instalments <= 0 become 1; the original is kept, and the flag is set
    for any payment type with instalments <= 0 (NULL stays NULL).
    """
    ptype = clean_text("payment_type")
    inst = F.col("payment_installments")
    return payments.where(
        F.col("order_id").isNotNull()
        & F.col("payment_sequential").isNotNull()
        & F.col("payment_value").isNotNull()
        & (F.col("payment_value") >= 0)
    ).select(
        "order_id",
        "payment_sequential",
        ptype.alias("payment_type"),
        inst.alias("original_payment_installments"),
        F.when((ptype == "credit_card") & (inst <= 0), F.lit(1).cast("bigint"))
        .otherwise(inst)
        .alias("payment_installments"),
        (inst <= 0).alias("installment_corrected_flag"),
        money("payment_value").alias("payment_value"),
    )


def stg_marketing_funnel(leads: DataFrame, deals: DataFrame) -> DataFrame:
    """Grain: mql_id (one row per lead, won or not).

    Leads left-join deals on mql_id. Deals are far fewer than leads; Spark
    broadcasts them when their measured size allows, else sort-merges.
    """
    mql = leads.where(F.col("mql_id").isNotNull()).alias("mql")
    deal = deals.alias("deal")
    j = mql.join(deal, F.col("mql.mql_id") == F.col("deal.mql_id"), "left")
    won = F.col("deal.mql_id").isNotNull()
    return j.select(
        F.col("mql.mql_id").alias("mql_id"),
        F.col("mql.first_contact_date").alias("first_contact_date"),
        F.col("mql.landing_page_id").alias("landing_page_id"),
        blank_to(F.col("mql.origin"), "unknown").alias("origin"),
        F.col("deal.seller_id").alias("seller_id"),
        F.col("deal.sdr_id").alias("sdr_id"),
        F.col("deal.sr_id").alias("sr_id"),
        F.col("deal.won_date").alias("won_date"),
        days_between(day_of(F.col("deal.won_date")), F.col("mql.first_contact_date")).alias("days_to_close"),
        clean_text(F.col("deal.business_segment")).alias("business_segment"),
        clean_text(F.col("deal.lead_type")).alias("lead_type"),
        clean_text(F.col("deal.lead_behaviour_profile")).alias("lead_behaviour_profile"),
        clean_text(F.col("deal.business_type")).alias("business_type"),
        won.alias("is_won"),
        F.when(won, "won").otherwise("not_won").alias("lead_status"),
    )


# ---------------------------------------------------------------- checks


def _rows(df: DataFrame):
    """Row count of ``df`` as a scalar-subquery column."""
    return df.select(F.count("*").cast("bigint")).scalar()


def row_reconcile(raw: DataFrame, staged: DataFrame) -> DataFrame:
    """One row: raw and staging row counts (two scalar subqueries)."""
    return raw.agg(F.count("*").cast("bigint").alias("raw_rows")).select("raw_rows", _rows(staged).alias("staging_rows"))


def stg_orders_reconcile(raw_orders: DataFrame, staged: DataFrame) -> DataFrame:
    """Raw vs staging row counts for orders."""
    return row_reconcile(raw_orders, staged)


def stg_order_items_reconcile(raw_items: DataFrame, staged: DataFrame) -> DataFrame:
    """Raw vs staging row counts for order items."""
    return row_reconcile(raw_items, staged)


def stg_order_payments_reconcile(raw_payments: DataFrame, staged: DataFrame) -> DataFrame:
    """Raw vs staging rows and the number of corrected instalment rows."""
    return staged.agg(
        _rows(raw_payments).alias("raw_rows"),
        F.count("*").cast("bigint").alias("staging_rows"),
        count_where(F.col("installment_corrected_flag")).alias("corrected_rows"),
    )


def funnel_conversion(funnel: DataFrame) -> DataFrame:
    """Leads, won leads and conversion %."""
    return funnel.agg(
        F.count("*").cast("bigint").alias("total_leads"),
        count_where(F.col("is_won")).alias("won_leads"),
        pct(F.count_if(F.col("is_won")), F.count("*")).alias("conversion_rate_pct"),
    )
