"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole input. Column types are normalised at this boundary only (exact
decimals become DOUBLE, narrow integers BIGINT); the library itself keeps
decimals end to end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mktlens import oracle as O
from mktlens import sources as S
from mktlens.functions import delay_bucket as _delay_bucket
from mktlens.functions import delivery_delay_days, clean_text
from mktlens.functions import delivery_status as _delivery_status
from mktlens.operators import attach_ranks, duplicate_key_rows, join_coverage, rank_table
from mktlens.plans import analysis, kpi, marts, profiling, staging
from mktlens.plans.quality import fanout_summary, kpi_summary
from mktlens.plans.warehouse import Warehouse

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def boundary_types(df: DataFrame) -> DataFrame:
    """Decimals -> double, byte/short/int -> bigint, float -> double."""
    cols = []
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, T.DecimalType | T.FloatType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(t, T.ByteType | T.ShortType | T.IntegerType):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: boundary_types(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse.at(spark, sf_dir)


D, B = "DOUBLE", "BIGINT"
MONEY_ITEMS = {"item_price": D, "freight_value": D, "item_total_value": D}

# ------------------------------------------------------------- staging


@register("stg_orders", O.select_view("stg_orders"))
def q_stg_orders(spark, sf):
    return wh(spark, sf).stg_orders


@register("stg_order_items", O.select_view("stg_order_items", MONEY_ITEMS))
def q_stg_order_items(spark, sf):
    return wh(spark, sf).stg_order_items


@register("stg_order_payments", O.select_view("stg_order_payments", {"payment_value": D}))
def q_stg_order_payments(spark, sf):
    return wh(spark, sf).stg_order_payments


@register("stg_marketing_funnel", O.select_view("stg_marketing_funnel"))
def q_stg_marketing_funnel(spark, sf):
    return wh(spark, sf).stg_marketing_funnel


@register(
    "stg_orders_reconcile",
    O.with_views(
        ("raw_orders", "stg_orders"),
        "SELECT (SELECT count(*) FROM raw_orders) AS raw_rows, (SELECT count(*) FROM stg_orders) AS staging_rows",
    ),
)
def q_stg_orders_reconcile(spark, sf):
    w = wh(spark, sf)
    return staging.stg_orders_reconcile(w.raw["orders"], w.stg_orders)


@register(
    "stg_order_items_reconcile",
    O.with_views(
        ("raw_order_items", "stg_order_items"),
        "SELECT (SELECT count(*) FROM raw_order_items) AS raw_rows, (SELECT count(*) FROM stg_order_items) AS staging_rows",
    ),
)
def q_stg_order_items_reconcile(spark, sf):
    w = wh(spark, sf)
    return staging.stg_order_items_reconcile(w.raw["order_items"], w.stg_order_items)


@register(
    "stg_order_payments_reconcile",
    O.with_views(
        ("raw_order_payments", "stg_order_payments"),
        "SELECT (SELECT count(*) FROM raw_order_payments) AS raw_rows, count(*) AS staging_rows, "
        "count_if(installment_corrected_flag) AS corrected_rows FROM stg_order_payments",
    ),
)
def q_stg_order_payments_reconcile(spark, sf):
    w = wh(spark, sf)
    return staging.stg_order_payments_reconcile(w.raw["order_payments"], w.stg_order_payments)


@register(
    "funnel_conversion",
    O.with_views(
        ("stg_marketing_funnel",),
        f"SELECT count(*) AS total_leads, count_if(is_won) AS won_leads, "
        f"{O.pct('count_if(is_won)', 'count(*)')} AS conversion_rate_pct FROM stg_marketing_funnel",
    ),
)
def q_funnel_conversion(spark, sf):
    return staging.funnel_conversion(wh(spark, sf).stg_marketing_funnel)


# ------------------------------------------------------------- marts

MART_ORDERS_CASTS = {"product_value": D, "freight_value": D, "item_total_value": D, "payment_value": D}


@register("order_item_summary", O.select_view("order_item_summary", {"product_value": D, "freight_value": D, "item_total_value": D}))
def q_order_item_summary(spark, sf):
    return marts.order_item_summary(wh(spark, sf).stg_order_items)


@register("order_payment_summary", O.select_view("order_payment_summary", {"payment_value": D}))
def q_order_payment_summary(spark, sf):
    return marts.order_payment_summary(wh(spark, sf).stg_order_payments)


@register("mart_orders", O.select_view("mart_orders", MART_ORDERS_CASTS))
def q_mart_orders(spark, sf):
    return wh(spark, sf).mart_orders


@register(
    "order_seller_summary",
    O.select_view("order_seller_summary", {"product_value": D, "freight_value": D, "item_total_value": D}),
)
def q_order_seller_summary(spark, sf):
    w = wh(spark, sf)
    return marts.order_seller_summary(w.stg_order_items, w.raw["products"], w.raw["product_category_translation"])


@register("review_summary", O.select_view("review_summary"))
def q_review_summary(spark, sf):
    return marts.review_summary(wh(spark, sf).raw["order_reviews"], rounded=True)


@register("review_summary_raw", O.select_view("review_summary_raw"))
def q_review_summary_raw(spark, sf):
    return marts.review_summary(wh(spark, sf).raw["order_reviews"], rounded=False)


@register(
    "mart_order_seller",
    O.select_view("mart_order_seller", {"product_value": D, "freight_value": D, "item_total_value": D}),
)
def q_mart_order_seller(spark, sf):
    return wh(spark, sf).mart_order_seller


@register("mart_marketing_funnel", O.select_view("mart_marketing_funnel"))
def q_mart_marketing_funnel(spark, sf):
    return wh(spark, sf).mart_marketing_funnel


@register(
    "seller_activity",
    O.select_view(
        "seller_activity",
        {"post_win_item_count": B, "post_win_product_value": D, "post_win_freight_value": D},
    ),
)
def q_seller_activity(spark, sf):
    w = wh(spark, sf)
    return marts.seller_activity(w.stg_marketing_funnel, w.order_seller_facts)


@register(
    "mart_seller_lifecycle",
    O.select_view(
        "mart_seller_lifecycle",
        {"post_win_item_count": B, "post_win_product_value": D, "post_win_freight_value": D},
    ),
)
def q_mart_seller_lifecycle(spark, sf):
    return wh(spark, sf).mart_seller_lifecycle


@register(
    "mart_orders_check",
    O.with_views(("mart_orders",), "SELECT count(*) AS mart_rows, count(DISTINCT order_id) AS unique_orders FROM mart_orders"),
)
def q_mart_orders_check(spark, sf):
    return marts.mart_orders_check(wh(spark, sf).mart_orders)


@register(
    "mart_order_seller_check",
    O.with_views(
        ("mart_order_seller",),
        "SELECT count(*) AS mart_rows, count(DISTINCT order_id || '|' || seller_id) AS unique_order_seller_pairs, "
        "count(DISTINCT seller_id) AS seller_count FROM mart_order_seller",
    ),
)
def q_mart_order_seller_check(spark, sf):
    return marts.mart_order_seller_check(wh(spark, sf).mart_order_seller)


@register(
    "mart_marketing_funnel_check",
    O.with_views(
        ("mart_marketing_funnel",),
        "SELECT CAST(sum(total_leads) AS BIGINT) AS total_leads, CAST(sum(won_leads) AS BIGINT) AS won_leads "
        "FROM mart_marketing_funnel",
    ),
)
def q_mart_marketing_funnel_check(spark, sf):
    return marts.mart_marketing_funnel_check(wh(spark, sf).mart_marketing_funnel)


@register(
    "mart_seller_lifecycle_check",
    O.with_views(
        ("mart_seller_lifecycle",),
        f"SELECT count(*) AS closed_leads, count_if(is_activated) AS activated_sellers, "
        f"{O.pct('count_if(is_activated)', 'count(*)')} AS closed_to_activation_rate_pct FROM mart_seller_lifecycle",
    ),
)
def q_mart_seller_lifecycle_check(spark, sf):
    return marts.mart_seller_lifecycle_check(wh(spark, sf).mart_seller_lifecycle)


# ------------------------------------------------------------- analyses


@register(
    "acquisition_channel_quality",
    O.select_view(
        "acquisition_channel_quality",
        {"total_leads": B, "won_leads": B, "post_win_order_count": B, "post_win_product_value": D},
    ),
)
def q_acquisition_channel_quality(spark, sf):
    return wh(spark, sf).acquisition_channel_quality


@register(
    "seller_activation_performance",
    O.select_view(
        "seller_activation_performance",
        {
            "post_win_item_count": B,
            "post_win_product_value": D,
            "post_win_freight_value": D,
            "overall_product_value_rank": B,
            "origin_product_value_rank": B,
            "overall_order_count_rank": B,
        },
    ),
)
def q_seller_activation_performance(spark, sf):
    return wh(spark, sf).seller_activation_performance


@register("delivery_review_analysis", O.select_view("delivery_review_analysis"))
def q_delivery_review_analysis(spark, sf):
    return wh(spark, sf).delivery_review_analysis


@register(
    "acquisition_totals_check",
    O.with_views(
        ("acquisition_channel_quality",),
        "SELECT CAST(sum(total_leads) AS BIGINT) AS total_leads, CAST(sum(won_leads) AS BIGINT) AS won_leads, "
        "CAST(sum(activated_sellers) AS BIGINT) AS activated_sellers FROM acquisition_channel_quality",
    ),
)
def q_acquisition_totals_check(spark, sf):
    return analysis.acquisition_totals_check(wh(spark, sf).acquisition_channel_quality)


@register(
    "activation_performance_check",
    O.with_views(
        ("seller_activation_performance",),
        "SELECT count(*) AS activated_seller_rows, count(DISTINCT seller_id) AS unique_activated_sellers, "
        "CAST(min(overall_product_value_rank) AS BIGINT) AS best_rank FROM seller_activation_performance",
    ),
)
def q_activation_performance_check(spark, sf):
    return analysis.activation_performance_check(wh(spark, sf).seller_activation_performance)


@register(
    "delivery_review_check",
    O.with_views(
        ("delivery_review_analysis",),
        "SELECT CAST(sum(order_count) AS BIGINT) AS total_orders, "
        "CAST(sum(reviewed_order_count) AS BIGINT) AS reviewed_orders FROM delivery_review_analysis",
    ),
)
def q_delivery_review_check(spark, sf):
    return analysis.delivery_review_check(wh(spark, sf).delivery_review_analysis)


# ------------------------------------------------------------- quality

Q1_CASTS = {"source_value": D, "model_value": D, "difference": D}
Q2_CASTS = {"source_value": B, "final_value": B, "difference": B}


@register("join_fanout_reconciliation", O.select_view("join_fanout_reconciliation", Q1_CASTS))
def q_join_fanout_reconciliation(spark, sf):
    return wh(spark, sf).join_fanout_reconciliation


@register("final_kpi_validation", O.select_view("final_kpi_validation", Q2_CASTS))
def q_final_kpi_validation(spark, sf):
    return wh(spark, sf).final_kpi_validation


SUMMARY_SQL = (
    "SELECT count(*) AS total_checks, count_if(check_status = 'PASS') AS passed_checks, "
    "count_if(check_status = 'FAIL') AS failed_checks FROM {v}"
)


@register("fanout_summary", O.with_views(("join_fanout_reconciliation",), SUMMARY_SQL.format(v="join_fanout_reconciliation")))
def q_fanout_summary(spark, sf):
    return fanout_summary(wh(spark, sf).join_fanout_reconciliation)


@register("kpi_summary", O.with_views(("final_kpi_validation",), SUMMARY_SQL.format(v="final_kpi_validation")))
def q_kpi_summary(spark, sf):
    return kpi_summary(wh(spark, sf).final_kpi_validation)


# ------------------------------------------------------------- profiling



def _raw(spark, sf):
    return wh(spark, sf).raw


@register("orders_grain", O.with_views(("raw_orders",), "SELECT count(*) AS total_rows, count(DISTINCT order_id) AS unique_order_ids FROM raw_orders"))
def q_orders_grain(spark, sf):
    return profiling.orders_grain(_raw(spark, sf)["orders"])


@register(
    "orders_missing_fields",
    O.with_views(
        ("raw_orders",),
        "SELECT count_if(order_id IS NULL) AS missing_order_id, count_if(customer_id IS NULL) AS missing_customer_id, "
        "count_if(order_purchase_timestamp IS NULL) AS missing_purchase_timestamp FROM raw_orders",
    ),
)
def q_orders_missing_fields(spark, sf):
    return profiling.orders_missing_fields(_raw(spark, sf)["orders"])


@register(
    "duplicate_order_items",
    O.with_views(
        ("raw_order_items",),
        "SELECT order_id, order_item_id, count(*) AS row_count FROM raw_order_items "
        "GROUP BY order_id, order_item_id HAVING count(*) > 1",
    ),
)
def q_duplicate_order_items(spark, sf):
    return profiling.duplicate_order_items(_raw(spark, sf)["order_items"])


@register(
    "duplicated_review_ids",
    O.with_views(
        ("raw_order_reviews",),
        "SELECT count(*) AS duplicated_review_ids FROM "
        "(SELECT review_id FROM raw_order_reviews GROUP BY review_id HAVING count(*) > 1)",
    ),
)
def q_duplicated_review_ids(spark, sf):
    return profiling.duplicated_review_ids(_raw(spark, sf)["order_reviews"])


@register(
    "duplicate_review_detail",
    O.with_views(
        ("raw_order_reviews",),
        "SELECT review_id, count(*) AS row_count, count(DISTINCT order_id) AS order_count, "
        "count(DISTINCT review_score) AS score_count FROM raw_order_reviews GROUP BY review_id "
        "HAVING count(*) > 1 ORDER BY row_count DESC, review_id LIMIT 20",
    ),
)
def q_duplicate_review_detail(spark, sf):
    return profiling.duplicate_review_detail(_raw(spark, sf)["order_reviews"])


@register(
    "orders_with_multiple_reviews",
    O.with_views(
        ("raw_order_reviews",),
        "SELECT count(*) AS orders_with_multiple_reviews FROM "
        "(SELECT order_id FROM raw_order_reviews GROUP BY order_id HAVING count(*) > 1)",
    ),
)
def q_orders_with_multiple_reviews(spark, sf):
    return profiling.orders_with_multiple_reviews(_raw(spark, sf)["order_reviews"])


@register("raw_profile", O.raw_profile_sql())
def q_raw_profile(spark, sf):
    return profiling.raw_profile(_raw(spark, sf))


@register("profile_table", O.raw_profile_sql(only="order_reviews"))
def q_profile_table(spark, sf):
    return profiling.profile_table(_raw(spark, sf)["order_reviews"], "order_reviews")


@register("schema_drift", O.schema_drift_sql())
def q_schema_drift(spark, sf):
    return profiling.drift_report(_raw(spark, sf))


@register("null_counts", O.raw_null_counts_sql())
def q_null_counts(spark, sf):
    return profiling.raw_null_counts(_raw(spark, sf))


@register("coverage_report", O.coverage_sql())
def q_coverage_report(spark, sf):
    return profiling.coverage_report(_raw(spark, sf))


@register(
    "duplicate_key_rows",
    O.with_views(
        ("raw_order_reviews",),
        "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_key_rows "
        "FROM (SELECT count(*) AS n FROM raw_order_reviews GROUP BY review_id)",
    ),
)
def q_duplicate_key_rows(spark, sf):
    return duplicate_key_rows(_raw(spark, sf)["order_reviews"], ["review_id"])


@register(
    "activation_summary",
    O.with_views(
        ("profiler_deal_activity",),
        "SELECT count(*) AS closed_deals, count_if(has_order) AS closed_sellers_with_any_order, "
        "count_if(first_post_win_day IS NOT NULL) AS post_win_activated_sellers, "
        "count_if(has_pre_win_order) AS sellers_with_pre_win_orders, "
        "CAST(median(date_diff('day', won_day, first_post_win_day)) AS DOUBLE) AS median_days_to_first_post_win_sale, "
        "CAST(min(date_diff('day', won_day, first_post_win_day)) AS BIGINT) AS minimum_days_to_first_post_win_sale, "
        "CAST(max(date_diff('day', won_day, first_post_win_day)) AS BIGINT) AS maximum_days_to_first_post_win_sale "
        "FROM profiler_deal_activity",
    ),
)
def q_activation_summary(spark, sf):
    r = _raw(spark, sf)
    return profiling.activation_summary(r["marketing_qualified_leads"], r["closed_deals"], r["order_items"], r["orders"])


@register(
    "activation_by_origin",
    O.with_views(
        ("profiler_deal_activity", "raw_marketing_qualified_leads"),
        f"""SELECT m.origin, m.mqls, coalesce(a.closed_deals, 0) AS closed_deals,
  coalesce(a.with_order, 0) AS closed_sellers_with_any_order, coalesce(a.activated, 0) AS post_win_activated_sellers,
  {O.rq('coalesce(a.closed_deals, 0)', 'm.mqls', 6)} AS mql_to_close_rate,
  {O.rq('coalesce(a.activated, 0)', 'coalesce(a.closed_deals, 0)', 6)} AS closed_to_activation_rate
FROM (SELECT CASE WHEN origin IS NULL OR origin = '' THEN 'unknown' ELSE origin END AS origin, count(*) AS mqls
      FROM raw_marketing_qualified_leads GROUP BY 1) AS m
LEFT JOIN (SELECT origin, count(*) AS closed_deals, count_if(has_order) AS with_order,
                  count_if(first_post_win_day IS NOT NULL) AS activated
           FROM profiler_deal_activity GROUP BY origin) AS a ON m.origin = a.origin
ORDER BY m.origin""",
    ),
)
def q_activation_by_origin(spark, sf):
    r = _raw(spark, sf)
    return profiling.activation_by_origin(r["marketing_qualified_leads"], r["closed_deals"], r["order_items"], r["orders"])


@register(
    "closed_seller_orders",
    O.with_views(
        ("raw_closed_deals", "raw_order_items", "raw_orders"),
        "SELECT order_id, CAST(order_purchase_timestamp AS DATE) AS order_day FROM raw_orders WHERE order_id IN "
        "(SELECT order_id FROM raw_order_items WHERE seller_id IN (SELECT seller_id FROM raw_closed_deals WHERE seller_id IS NOT NULL))",
    ),
)
def q_closed_seller_orders(spark, sf):
    r = _raw(spark, sf)
    return profiling.closed_seller_orders(r["closed_deals"], r["order_items"], r["orders"])


@register(
    "join_lead_deal",
    O.with_views(
        ("raw_marketing_qualified_leads", "raw_closed_deals"),
        "SELECT mql.mql_id, mql.origin, deal.seller_id, deal.won_date FROM raw_marketing_qualified_leads AS mql "
        "LEFT JOIN raw_closed_deals AS deal ON mql.mql_id = deal.mql_id",
    ),
)
def q_join_lead_deal(spark, sf):
    r = _raw(spark, sf)
    m, d = r["marketing_qualified_leads"].alias("m"), r["closed_deals"].alias("d")
    return m.join(d, F.col("m.mql_id") == F.col("d.mql_id"), "left").select(
        F.col("m.mql_id").alias("mql_id"), F.col("m.origin").alias("origin"), "d.seller_id", "d.won_date"
    )


# ------------------------------------------------------------- KPI layer


@register(
    "kpi_monthly",
    O.with_views(
        ("mart_orders", "review_summary_raw", "stg_order_items", "stg_orders"),
        f"""WITH base AS (
  SELECT o.*, r.average_review_score AS order_review_score FROM mart_orders AS o
  LEFT JOIN review_summary_raw AS r ON o.order_id = r.order_id
), monthly AS (
  SELECT purchase_month, count(*) AS order_count, count_if(item_count > 0) AS orders_with_items,
    CAST(sum(product_value) AS DOUBLE) AS product_gmv,
    {O.rq('CAST(round(sum(product_value) * 100) AS BIGINT)', '(count(*) * 100)')} AS aov,
    count_if(delivery_status <> 'not_delivered') AS delivered_orders,
    count_if(delivery_status = 'on_time') AS on_time_orders, count_if(delivery_status = 'late') AS late_orders,
    {O.pct("count_if(delivery_status = 'on_time')", "count_if(delivery_status = 'on_time') + count_if(delivery_status = 'late')")} AS on_time_rate_pct,
    count_if(order_review_score IS NOT NULL) AS reviewed_orders,
    {O.round_d('avg(order_review_score)')} AS average_review_score
  FROM base GROUP BY purchase_month
), sellers AS (
  SELECT o.purchase_month, count(DISTINCT i.seller_id) AS active_sellers
  FROM stg_order_items AS i JOIN stg_orders AS o ON i.order_id = o.order_id GROUP BY o.purchase_month
)
SELECT m.purchase_month, m.order_count, m.orders_with_items, m.product_gmv, m.aov,
  coalesce(s.active_sellers, 0) AS active_sellers, m.delivered_orders, m.on_time_orders, m.late_orders,
  m.on_time_rate_pct, m.reviewed_orders, m.average_review_score
FROM monthly AS m LEFT JOIN sellers AS s ON m.purchase_month = s.purchase_month""",
    ),
)
def q_kpi_monthly(spark, sf):
    w = wh(spark, sf)
    return kpi.kpi_monthly(w.mart_orders, w.stg_order_items, w.stg_orders, w.raw["order_reviews"])


@register(
    "kpi_monthly_by_state",
    O.with_views(
        ("mart_orders", "stg_order_items"),
        f"""WITH sold AS (
  SELECT o.purchase_month, o.customer_state, count(DISTINCT i.seller_id) AS active_sellers
  FROM mart_orders AS o JOIN stg_order_items AS i ON o.order_id = i.order_id GROUP BY ALL
)
SELECT o.purchase_month, o.customer_state, count(DISTINCT o.order_id) AS order_count,
  CAST(sum(o.product_value) AS DOUBLE) AS product_gmv,
  {O.rq('CAST(round(sum(o.product_value) * 100) AS BIGINT)', '(count(DISTINCT o.order_id) * 100)')} AS aov,
  coalesce(any_value(s.active_sellers), 0) AS active_sellers
FROM mart_orders AS o LEFT JOIN sold AS s
  ON o.purchase_month IS NOT DISTINCT FROM s.purchase_month AND o.customer_state IS NOT DISTINCT FROM s.customer_state
GROUP BY o.purchase_month, o.customer_state""",
    ),
)
def q_kpi_monthly_by_state(spark, sf):
    w = wh(spark, sf)
    by = ("purchase_month", "customer_state")
    k = kpi.kpi_monthly(w.mart_orders, w.stg_order_items, w.stg_orders, w.raw["order_reviews"], by)
    return k.select(*by, "order_count", "product_gmv", "aov", "active_sellers")


def _context_sql(columns: tuple[str, ...]) -> str:
    shown = ", ".join(f"o.{c} AS {c}" if c in columns else f"NULL AS {c}" for c in ("purchase_month", "customer_state"))
    grouped = "GROUP BY " + ", ".join(f"o.{c}" for c in columns) if columns else "HAVING count(*) > 0"
    return f"""SELECT '{", ".join(columns) or "total"}' AS context, {shown}, count(DISTINCT o.order_id) AS order_count,
  count(DISTINCT CASE WHEN o.item_count > 0 THEN o.order_id END) AS orders_with_items,
  CAST(sum(CASE WHEN o.first THEN o.product_value END) AS DOUBLE) AS product_gmv,
  {O.rq('CAST(round(sum(CASE WHEN o.first THEN o.product_value END) * 100) AS BIGINT)', '(count(DISTINCT o.order_id) * 100)')} AS aov,
  count(DISTINCT o.seller_id) AS active_sellers,
  count_if(o.first AND o.delivery_status <> 'not_delivered') AS delivered_orders,
  count_if(o.first AND o.delivery_status = 'on_time') AS on_time_orders, count_if(o.first AND o.delivery_status = 'late') AS late_orders,
  {O.pct("count_if(o.first AND o.delivery_status = 'on_time')", "count_if(o.first AND o.delivery_status IN ('on_time', 'late'))")} AS on_time_rate_pct,
  count_if(o.first AND o.score IS NOT NULL) AS reviewed_orders,
  {O.round_d('avg(CASE WHEN o.first THEN o.score END)')} AS average_review_score
FROM sold AS o {grouped}"""


@register(
    "kpi_contexts",
    O.with_views(
        ("mart_orders", "stg_order_items", "review_summary_raw"),
        """WITH sold AS (
  SELECT m.*, r.average_review_score AS score, i.seller_id,
         row_number() OVER (PARTITION BY m.order_id ORDER BY i.seller_id) = 1 AS first
  FROM mart_orders AS m LEFT JOIN review_summary_raw AS r ON m.order_id = r.order_id
  LEFT JOIN (SELECT DISTINCT order_id, seller_id FROM stg_order_items) AS i ON m.order_id = i.order_id
)
"""
        + "\nUNION ALL\n".join(
            _context_sql(c) for c in (("purchase_month", "customer_state"), ("purchase_month",), ("customer_state",), ())
        ),
    ),
)
def q_kpi_contexts(spark, sf):
    """Month and state, month, state and total rows together."""
    w = wh(spark, sf)
    return kpi.kpi_contexts(w.mart_orders, w.stg_order_items, w.raw["order_reviews"])


@register(
    "kpi_channel",
    O.with_views(
        ("stg_marketing_funnel", "mart_seller_lifecycle"),
        f"""SELECT l.origin, l.leads, l.won_leads, coalesce(a.activated_sellers, 0) AS activated_sellers,
  {O.pct('l.won_leads', 'l.leads')} AS lead_to_close_rate_pct,
  {O.pct('coalesce(a.activated_sellers, 0)', 'l.won_leads')} AS closed_to_activation_rate_pct
FROM (SELECT origin, count(*) AS leads, count_if(is_won) AS won_leads FROM stg_marketing_funnel GROUP BY origin) AS l
LEFT JOIN (SELECT origin, count_if(is_activated) AS activated_sellers FROM mart_seller_lifecycle GROUP BY origin) AS a
  ON l.origin = a.origin""",
    ),
)
def q_kpi_channel(spark, sf):
    w = wh(spark, sf)
    return kpi.kpi_channel(w.stg_marketing_funnel, w.mart_seller_lifecycle)


@register(
    "kpi_fulfilment",
    O.with_views(
        ("mart_orders", "review_summary_raw"),
        f"""SELECT o.delivery_status, count(*) AS order_count, {O.avg_r('o.delivery_days')} AS average_delivery_days,
  CAST(sum(o.freight_value) AS DOUBLE) AS freight_value,
  {O.rq('CAST(round(sum(o.freight_value) * 100) AS BIGINT)', '(count(*) * 100)')} AS average_freight_per_order,
  count_if(r.average_review_score IS NOT NULL) AS reviewed_orders,
  {O.round_d('avg(r.average_review_score)')} AS average_review_score,
  {O.pct('count_if(r.average_review_score <= 2)', 'count_if(r.average_review_score IS NOT NULL)')} AS low_review_rate_pct
FROM mart_orders AS o LEFT JOIN review_summary_raw AS r ON o.order_id = r.order_id
GROUP BY o.delivery_status""",
    ),
)
def q_kpi_fulfilment(spark, sf):
    w = wh(spark, sf)
    return kpi.kpi_fulfilment(w.mart_orders, w.raw["order_reviews"])


@register(
    "kpi_seller",
    O.with_views(
        ("mart_order_seller",),
        f"""SELECT seller_id, seller_city, seller_state, count(*) AS order_count,
  CAST(sum(item_count) AS BIGINT) AS item_count, CAST(sum(product_value) AS DOUBLE) AS product_gmv,
  CAST(sum(freight_value) AS DOUBLE) AS freight_value,
  count_if(delivery_status = 'on_time') AS on_time_orders, count_if(delivery_status = 'late') AS late_orders,
  {O.pct("count_if(delivery_status = 'on_time')", "count_if(delivery_status = 'on_time') + count_if(delivery_status = 'late')")} AS on_time_rate_pct,
  count(average_review_score) AS reviewed_orders, {O.avg_h('average_review_score')} AS average_review_score
FROM mart_order_seller GROUP BY seller_id, seller_city, seller_state""",
    ),
)
def q_kpi_seller(spark, sf):
    w = wh(spark, sf)
    return kpi.kpi_seller(w.order_seller_facts, w.raw["sellers"])


@register(
    "post_win_sales",
    O.with_views(
        ("stg_marketing_funnel", "mart_order_seller"),
        f"""SELECT f.origin, {O.month('m.purchase_date')} AS purchase_month, count(DISTINCT f.mql_id || '|' || m.order_id) AS post_win_orders,
  CAST(sum(m.item_count) AS BIGINT) AS post_win_items, CAST(sum(m.product_value) AS DOUBLE) AS post_win_product_value
FROM stg_marketing_funnel AS f
JOIN mart_order_seller AS m ON f.seller_id = m.seller_id AND m.purchase_date >= CAST(f.won_date AS DATE)
WHERE f.is_won GROUP BY 1, 2""",
    ),
)
def q_post_win_sales(spark, sf):
    w = wh(spark, sf)
    return kpi.post_win_sales(w.stg_marketing_funnel, w.order_seller_facts)


@register(
    "seller_detail",
    O.with_views(
        ("mart_order_seller",),
        "SELECT * REPLACE (CAST(product_value AS DOUBLE) AS product_value, CAST(freight_value AS DOUBLE) AS freight_value, "
        "CAST(item_total_value AS DOUBLE) AS item_total_value) FROM mart_order_seller WHERE seller_id = "
        "(SELECT seller_id FROM mart_order_seller GROUP BY seller_id ORDER BY count(*) DESC, seller_id LIMIT 1)",
    ),
)
def q_seller_detail(spark, sf):
    w = wh(spark, sf)
    return kpi.seller_detail(w.mart_order_seller, kpi.top_seller_id(w.stg_order_items))


@register(
    "dim_date",
    O.with_views(
        ("stg_orders", "stg_marketing_funnel"),
        """WITH b AS (
  SELECT min(d) AS lo, max(d) AS hi FROM (
    SELECT purchase_date AS d FROM stg_orders UNION ALL SELECT first_contact_date FROM stg_marketing_funnel
    UNION ALL SELECT CAST(won_date AS DATE) FROM stg_marketing_funnel)
), days AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM b WHERE lo IS NOT NULL)
SELECT date, CAST(year(date) AS BIGINT) AS year, CAST(quarter(date) AS BIGINT) AS quarter,
  CAST(month(date) AS BIGINT) AS month, CAST(date_trunc('month', date) AS DATE) AS month_start,
  CAST(isodow(date) AS BIGINT) AS iso_day_of_week, CAST(weekofyear(date) AS BIGINT) AS iso_week FROM days""",
    ),
)
def q_dim_date(spark, sf):
    w = wh(spark, sf)
    return kpi.dim_date(w.stg_orders, w.stg_marketing_funnel)


@register(
    "dim_seller",
    O.with_views(
        ("raw_sellers", "raw_closed_deals", "stg_order_items"),
        f"""SELECT s.seller_id, s.seller_zip_code_prefix, {O.clean('s.seller_city')} AS seller_city, s.seller_state,
  coalesce(w.won_leads, 0) AS won_leads, coalesce(o.has_orders, false) AS has_orders
FROM raw_sellers AS s
LEFT JOIN (SELECT seller_id, count(*) AS won_leads FROM raw_closed_deals GROUP BY seller_id) AS w ON s.seller_id = w.seller_id
LEFT JOIN (SELECT DISTINCT seller_id, true AS has_orders FROM stg_order_items) AS o ON s.seller_id = o.seller_id""",
    ),
)
def q_dim_seller(spark, sf):
    w = wh(spark, sf)
    return kpi.dim_seller(w.raw["sellers"], w.raw["closed_deals"], w.stg_order_items)


@register(
    "dim_origin",
    O.with_views(("stg_marketing_funnel",), "SELECT origin, count(*) AS lead_count FROM stg_marketing_funnel GROUP BY origin"),
)
def q_dim_origin(spark, sf):
    return kpi.dim_origin(wh(spark, sf).stg_marketing_funnel)


# ------------------------------------------------------------- sources and sinks


# The table files of the test data directory.
TEST_TABLE_FILES = tuple(
    f"{t}.parquet"
    for t in (
        "benchmark",
        "conversations",
        "customer",
        "documents",
        "embeddings",
        "events",
        "labels",
        "lineitem",
        "nation",
        "orders",
        "pages",
        "part",
        "region",
        "supplier",
    )
)


def _csv_roundtrip(spark, sf, table: str) -> DataFrame:
    raw = _raw(spark, sf)[table]
    path = S.scratch_path(spark, f"csv-{table}")
    S.write_csv(raw, path)
    return S.read_csv(spark, path, S.RAW_SCHEMAS[table])


@register("csv_scan", O.select_view("raw_order_reviews"))
def q_csv_scan(spark, sf):
    return _csv_roundtrip(spark, sf, "order_reviews")


@register("csv_scan_deals", O.select_view("raw_closed_deals"))
def q_csv_scan_deals(spark, sf):
    return _csv_roundtrip(spark, sf, "closed_deals")


TEST_TABLES = [n.removesuffix(".parquet") for n in TEST_TABLE_FILES]


@register("source_files")
def q_source_files(spark, sf):
    return S.file_inventory(spark, sf, TEST_TABLES)


@register(
    "file_set_diff",
    "SELECT name, CAST(1 AS BIGINT) AS found_count, 'ok' AS status FROM (VALUES "
    + ", ".join(f"('{n}')" for n in TEST_TABLE_FILES)
    + ") AS t(name)",
)
def q_file_set_diff(spark, sf):
    """The table files (or folders) listed below the directory against the
    expected set."""
    return S.file_set_diff(S.list_tables(spark, sf), TEST_TABLE_FILES)


@register(
    "find_source",
    "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{t}.parquet' AS name, count(*) AS row_count FROM {t}" for t in TEST_TABLES
    ),
)
def q_find_source(spark, sf):
    """Every expected table found by its name below the directory, and read from
    the place where it was found."""
    out = None
    for name, path in S.find_tables(spark, sf, TEST_TABLE_FILES).items():
        rows = spark.read.parquet(path).agg(F.count("*").cast("bigint").alias("row_count"))
        part = rows.select(F.lit(name.removesuffix(".parquet")).alias("table_name"), F.lit(name).alias("name"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out


@register("schema_view", O.select_view("mart_marketing_funnel"))
def q_schema_view(spark, sf):
    """The funnel mart written, and read back through a view of its layer's schema."""
    m3 = wh(spark, sf).mart_marketing_funnel
    path = S.scratch_path(spark, "schema-view")
    m3.write.parquet(path)
    S.create_view(spark, "marts", "mart_marketing_funnel", m3.columns, path)
    return spark.table("marts.mart_marketing_funnel")


@register(
    "table_inventory",
    "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TEST_TABLES),
)
def q_table_inventory(spark, sf):
    return S.table_inventory(spark, sf, TEST_TABLES).select("table_name", "row_count")


@register("table_sizes")
def q_table_sizes(spark, sf):
    return S.table_inventory(spark, sf, TEST_TABLES)


@register("profile_sink", O.raw_profile_sql())
def q_profile_sink(spark, sf):
    report = profiling.raw_profile(_raw(spark, sf))
    path = S.scratch_path(spark, "profile")
    S.write_profile(report, path)
    return spark.read.schema(report.schema).json(path).select(*report.columns)


# ------------------------------------------------------------- single operators
# Operators that the marts use internally, exposed one by one.



@register(
    "join_order_items_summary",
    O.with_views(
        ("stg_orders", "order_item_summary"),
        "SELECT o.order_id, o.purchase_date, i.item_count, CAST(i.product_value AS DOUBLE) AS product_value "
        "FROM stg_orders AS o LEFT JOIN order_item_summary AS i ON o.order_id = i.order_id",
    ),
)
def q_join_order_items_summary(spark, sf):
    w = wh(spark, sf)
    i = marts.order_item_summary(w.stg_order_items).select("order_id", "item_count", "product_value")
    return w.stg_orders.select("order_id", "purchase_date").join(i, "order_id", "left")


@register(
    "join_order_payment_summary",
    O.with_views(
        ("stg_orders", "order_payment_summary"),
        "SELECT o.order_id, p.payment_record_count, p.payment_types, CAST(p.payment_value AS DOUBLE) AS payment_value "
        "FROM stg_orders AS o LEFT JOIN order_payment_summary AS p ON o.order_id = p.order_id",
    ),
)
def q_join_order_payment_summary(spark, sf):
    w = wh(spark, sf)
    p = marts.order_payment_summary(w.stg_order_payments).select(
        "order_id", "payment_record_count", "payment_types", "payment_value"
    )
    return w.stg_orders.select("order_id").join(p, "order_id", "left")


@register(
    "join_order_customer",
    O.with_views(
        ("stg_orders", "raw_customers"),
        f"SELECT o.order_id, o.customer_id, c.customer_unique_id, {O.clean('c.customer_city')} AS customer_city, "
        "c.customer_state FROM stg_orders AS o LEFT JOIN raw_customers AS c ON o.customer_id = c.customer_id",
    ),
)
def q_join_order_customer(spark, sf):
    w = wh(spark, sf)
    c = w.raw["customers"].select("customer_id", "customer_unique_id", "customer_city", "customer_state")
    j = w.stg_orders.select("order_id", "customer_id").join(c, "customer_id", "left")
    return j.select(
        "order_id", "customer_id", "customer_unique_id", clean_text("customer_city").alias("customer_city"), "customer_state"
    )


@register(
    "join_item_product",
    O.with_views(
        ("stg_order_items", "raw_products"),
        "SELECT i.order_id, i.order_item_id, i.product_id, p.product_category_name "
        "FROM stg_order_items AS i LEFT JOIN raw_products AS p ON i.product_id = p.product_id",
    ),
)
def q_join_item_product(spark, sf):
    w = wh(spark, sf)
    p = w.raw["products"].select("product_id", "product_category_name")
    return w.stg_order_items.select("order_id", "order_item_id", "product_id").join(p, "product_id", "left")


@register(
    "join_category_translation",
    O.with_views(
        ("raw_products", "raw_product_category_translation"),
        f"SELECT p.product_id, p.product_category_name, {O.CATEGORY} AS product_category "
        "FROM raw_products AS p LEFT JOIN raw_product_category_translation AS t "
        "ON p.product_category_name = t.product_category_name",
    ),
)
def q_join_category_translation(spark, sf):
    r = _raw(spark, sf)
    p = r["products"].select("product_id", "product_category_name").alias("p")
    t = r["product_category_translation"].alias("t")
    j = p.join(t, F.col("p.product_category_name") == F.col("t.product_category_name"), "left")
    return j.select(
        "p.product_id",
        F.col("p.product_category_name").alias("product_category_name"),
        marts.product_category(F.col("t.product_category_name_english"), F.col("p.product_category_name")).alias(
            "product_category"
        ),
    )


@register(
    "post_win_join",
    O.with_views(
        ("stg_marketing_funnel", "mart_order_seller"),
        """SELECT f.mql_id, m.purchase_date, count(m.order_id) AS orders, CAST(sum(m.product_value) AS DOUBLE) AS product_value
FROM stg_marketing_funnel AS f
LEFT JOIN mart_order_seller AS m ON f.seller_id = m.seller_id AND m.purchase_date >= CAST(f.won_date AS DATE)
WHERE f.is_won GROUP BY f.mql_id, m.purchase_date""",
    ),
)
def q_post_win_join(spark, sf):
    """Won leads joined to the per-(seller, day) activity on seller and date."""
    w = wh(spark, sf)
    won = w.stg_marketing_funnel.where(F.col("is_won")).select("mql_id", "seller_id", F.to_date("won_date").alias("won_day"))
    return marts.post_win_days(won, marts.seller_daily_activity(w.mart_order_seller))


@register(
    "join_coverage",
    O.with_views(
        ("raw_closed_deals", "raw_order_items"),
        f"""SELECT count(*) AS distinct_left_keys, count_if(r.key IS NOT NULL) AS matched_left_keys,
  count(*) - count_if(r.key IS NOT NULL) AS unmatched_left_keys, {O.rq('count_if(r.key IS NOT NULL)', 'count(*)', 6)} AS match_rate
FROM (SELECT DISTINCT seller_id AS key FROM raw_closed_deals WHERE seller_id IS NOT NULL AND seller_id <> '') AS l
LEFT JOIN (SELECT DISTINCT seller_id AS key FROM raw_order_items WHERE seller_id IS NOT NULL AND seller_id <> '') AS r
  ON l.key = r.key""",
    ),
)
def q_join_coverage(spark, sf):
    r = _raw(spark, sf)
    return join_coverage(r["closed_deals"], "seller_id", r["order_items"], "seller_id")


@register(
    "order_payment_types",
    O.with_views(("order_payment_summary",), "SELECT order_id, payment_types FROM order_payment_summary"),
)
def q_order_payment_types(spark, sf):
    return marts.order_payment_summary(wh(spark, sf).stg_order_payments).select("order_id", "payment_types")


@register(
    "order_seller_categories",
    O.with_views(("order_seller_summary",), "SELECT order_id, seller_id, product_categories FROM order_seller_summary"),
)
def q_order_seller_categories(spark, sf):
    w = wh(spark, sf)
    s = marts.order_seller_summary(w.stg_order_items, w.raw["products"], w.raw["product_category_translation"])
    return s.select("order_id", "seller_id", "product_categories")


@register(
    "activation_delay_stats",
    O.with_views(
        ("profiler_deal_activity",),
        "SELECT CAST(median(date_diff('day', won_day, first_post_win_day)) AS DOUBLE) AS median_days_to_first_post_win_sale, "
        "CAST(min(date_diff('day', won_day, first_post_win_day)) AS BIGINT) AS minimum_days_to_first_post_win_sale, "
        "CAST(max(date_diff('day', won_day, first_post_win_day)) AS BIGINT) AS maximum_days_to_first_post_win_sale "
        "FROM profiler_deal_activity",
    ),
)
def q_activation_delay_stats(spark, sf):
    r = _raw(spark, sf)
    s = profiling.activation_summary(r["marketing_qualified_leads"], r["closed_deals"], r["order_items"], r["orders"])
    return s.select(
        "median_days_to_first_post_win_sale", "minimum_days_to_first_post_win_sale", "maximum_days_to_first_post_win_sale"
    )


def _activated(spark, sf) -> DataFrame:
    m4 = wh(spark, sf).mart_seller_lifecycle
    return m4.where(F.col("is_activated")).select("mql_id", "origin", "post_win_product_value", "post_win_order_count")


def _one_rank(spark, sf, value: str, out: str, keys: list[str]) -> DataFrame:
    base = _activated(spark, sf)
    return attach_ranks(base, [(rank_table(base, value, out, keys), value, keys)])


RANK_SQL = "SELECT mql_id, origin, CAST(post_win_product_value AS DOUBLE) AS post_win_product_value, post_win_order_count, rank() OVER ({w}) AS {out} FROM mart_seller_lifecycle WHERE is_activated"


@register(
    "rank_overall_value",
    O.with_views(("mart_seller_lifecycle",), RANK_SQL.format(w="ORDER BY post_win_product_value DESC", out="overall_product_value_rank")),
)
def q_rank_overall_value(spark, sf):
    return _one_rank(spark, sf, "post_win_product_value", "overall_product_value_rank", [])


@register(
    "rank_within_origin",
    O.with_views(
        ("mart_seller_lifecycle",),
        RANK_SQL.format(w="PARTITION BY origin ORDER BY post_win_product_value DESC", out="origin_product_value_rank"),
    ),
)
def q_rank_within_origin(spark, sf):
    return _one_rank(spark, sf, "post_win_product_value", "origin_product_value_rank", ["origin"])


@register(
    "rank_overall_orders",
    O.with_views(("mart_seller_lifecycle",), RANK_SQL.format(w="ORDER BY post_win_order_count DESC", out="overall_order_count_rank")),
)
def q_rank_overall_orders(spark, sf):
    return _one_rank(spark, sf, "post_win_order_count", "overall_order_count_rank", [])


@register(
    "delivery_status",
    O.with_views(
        ("stg_orders",),
        f"SELECT order_id, {O.STATUS.format(d='order_delivered_customer_date', e='order_estimated_delivery_date')} AS delivery_status FROM stg_orders",
    ),
)
def q_delivery_status(spark, sf):
    o = wh(spark, sf).stg_orders
    return o.select("order_id", _delivery_status("order_delivered_customer_date", "order_estimated_delivery_date").alias("delivery_status"))


@register(
    "delay_bucket",
    O.with_views(("order_review_base",), "SELECT order_id, delivery_delay_days, delivery_delay_bucket FROM order_review_base"),
)
def q_delay_bucket(spark, sf):
    o = wh(spark, sf).stg_orders
    d, e = "order_delivered_customer_date", "order_estimated_delivery_date"
    return o.select("order_id", delivery_delay_days(d, e).alias("delivery_delay_days"), _delay_bucket(d, e).alias("delivery_delay_bucket"))
