"""Analyses: channel quality, activated-seller ranking, delivery vs reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktlens.functions import (
    avg_rounded,
    avg_rounded_hundredths,
    cents,
    count_where,
    delay_bucket,
    delivery_delay_days,
    pct,
    round_double,
    rounded_quotient,
)
from mktlens.operators import attach_ranks, rank_rollup, rank_table
from mktlens.plans.marts import review_summary
from mktlens.sources.sinks import materialize


def acquisition_channel_quality(m3: DataFrame, m4: DataFrame) -> DataFrame:
    """Grain: origin (12 columns). Lead metrics from the funnel mart, seller
    metrics from the lifecycle mart; both are reduced to one row per origin
    before they meet, so the join is between two small aggregates."""
    leads = m3.groupBy("origin").agg(
        F.sum("total_leads").cast("bigint").alias("total_leads"),
        F.sum("won_leads").cast("bigint").alias("won_leads"),
        pct(F.sum("won_leads"), F.sum("total_leads")).alias("lead_to_close_rate_pct"),
    ).alias("leads")
    act = F.col("is_activated")
    on_time, late = F.sum("on_time_order_count"), F.sum("late_order_count")
    sellers = m4.groupBy("origin").agg(
        F.count("*").cast("bigint").alias("closed_leads"),
        count_where(act).alias("activated_sellers"),
        pct(F.count_if(act), F.count("*")).alias("closed_to_activation_rate_pct"),
        avg_rounded(F.when(act, F.col("days_to_first_sale"))).alias("average_days_to_first_sale"),
        F.sum("post_win_order_count").cast("bigint").alias("post_win_order_count"),
        F.sum("post_win_product_value").alias("post_win_product_value"),
        rounded_quotient(cents(F.sum("post_win_product_value")), F.count_if(act) * 100).alias(
            "product_value_per_activated_seller"
        ),
        avg_rounded_hundredths(F.when(act, F.col("average_review_score"))).alias("average_review_score"),
        pct(on_time, on_time + late).alias("on_time_delivery_rate_pct"),
    ).alias("sellers")
    j = leads.join(sellers, F.col("leads.origin") == F.col("sellers.origin"), "left")
    zero = F.lit(0)
    return j.select(
        F.col("leads.origin").alias("origin"),
        F.col("leads.total_leads").alias("total_leads"),
        F.col("leads.won_leads").alias("won_leads"),
        F.col("leads.lead_to_close_rate_pct").alias("lead_to_close_rate_pct"),
        F.coalesce(F.col("sellers.activated_sellers"), zero).cast("bigint").alias("activated_sellers"),
        F.col("sellers.closed_to_activation_rate_pct").alias("closed_to_activation_rate_pct"),
        F.col("sellers.average_days_to_first_sale").alias("average_days_to_first_sale"),
        F.coalesce(F.col("sellers.post_win_order_count"), zero).cast("bigint").alias("post_win_order_count"),
        F.coalesce(F.col("sellers.post_win_product_value"), zero).alias("post_win_product_value"),
        F.col("sellers.product_value_per_activated_seller").alias("product_value_per_activated_seller"),
        F.col("sellers.average_review_score").alias("average_review_score"),
        F.col("sellers.on_time_delivery_rate_pct").alias("on_time_delivery_rate_pct"),
    )


def seller_activation_performance(m4: DataFrame) -> DataFrame:
    """Grain: activated won lead (17 columns) with three ranks (ties share a
    rank and leave gaps). Both ranks by product value come from one count table
    and one join; no window takes all rows, or all rows of an origin, into one
    task."""
    base = m4.where(F.col("is_activated")).select(
        "mql_id",
        "seller_id",
        "origin",
        "business_segment",
        "won_date",
        "first_post_win_order_date",
        "days_to_first_sale",
        "post_win_order_count",
        "post_win_item_count",
        "post_win_product_value",
        "post_win_freight_value",
        rounded_quotient(cents("post_win_product_value"), F.col("post_win_order_count") * 100).alias(
            "product_value_per_order"
        ),
        "average_review_score",
        "on_time_delivery_rate_pct",
    )
    # Written once: rows, count tables, cut points and offsets all read it, and
    # each would otherwise carry a copy of the whole lifecycle in its plan.
    base = materialize(base, "activated-leads")
    pv, n = "post_win_product_value", "post_win_order_count"
    overall, within, orders = "overall_product_value_rank", "origin_product_value_rank", "overall_order_count_rank"
    by_value = rank_rollup(base, pv, overall, within, ["origin"])
    r = attach_ranks(base, [(by_value, pv, ["origin"]), (rank_table(base, n, orders), n, [])])
    return r.select(*base.columns, overall, within, orders)


def order_review_base(m1: DataFrame, reviews: DataFrame) -> DataFrame:
    """Per order: delivery status, delay days and bucket, unrounded review summary."""
    o = m1.alias("o")
    r = review_summary(reviews, rounded=False).alias("r")
    delivered, estimated = "o.order_delivered_customer_date", "o.order_estimated_delivery_date"
    return o.join(r, F.col("o.order_id") == F.col("r.order_id"), "left").select(
        F.col("o.order_id").alias("order_id"),
        F.col("o.delivery_status").alias("delivery_status"),
        delivery_delay_days(delivered, estimated).alias("delivery_delay_days"),
        F.col("r.review_row_count").alias("review_row_count"),
        F.col("r.review_count").alias("review_count"),
        F.col("r.average_review_score").alias("average_review_score"),
        delay_bucket(delivered, estimated).alias("delivery_delay_bucket"),
    )


def delivery_review_analysis(m1: DataFrame, reviews: DataFrame) -> DataFrame:
    """Grain: delay bucket (7 columns). Association only, not causation."""
    base = order_review_base(m1, reviews)
    score = F.col("average_review_score")
    reviewed = F.count_if(score.isNotNull())
    delay = F.col("delivery_delay_days")
    return base.groupBy("delivery_delay_bucket").agg(
        F.count("*").cast("bigint").alias("order_count"),
        reviewed.cast("bigint").alias("reviewed_order_count"),
        round_double(F.avg(score)).alias("average_review_score"),
        pct(F.count_if(score <= 2), reviewed).alias("low_review_rate_pct"),
        pct(F.count_if(score >= 4), reviewed).alias("high_review_rate_pct"),
        avg_rounded(F.when(delay > 0, delay)).alias("average_late_days"),
    )


# ------------------------------------------------------------------ checks


def acquisition_totals_check(a1: DataFrame) -> DataFrame:
    return a1.agg(
        F.sum("total_leads").cast("bigint").alias("total_leads"),
        F.sum("won_leads").cast("bigint").alias("won_leads"),
        F.sum("activated_sellers").cast("bigint").alias("activated_sellers"),
    )


def activation_performance_check(a2: DataFrame) -> DataFrame:
    return a2.agg(
        F.count("*").cast("bigint").alias("activated_seller_rows"),
        F.count_distinct("seller_id").cast("bigint").alias("unique_activated_sellers"),
        F.min("overall_product_value_rank").cast("bigint").alias("best_rank"),
    )


def delivery_review_check(a3: DataFrame) -> DataFrame:
    return a3.agg(
        F.sum("order_count").cast("bigint").alias("total_orders"),
        F.sum("reviewed_order_count").cast("bigint").alias("reviewed_orders"),
    )
