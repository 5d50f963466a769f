"""Marts: order, order-seller, marketing funnel, seller lifecycle.

Every one-to-many source is aggregated to the join key *before* it is joined,
so no mart multiplies rows or money (the fan-out checks in ``quality`` prove
it). Aggregates are written so Spark can combine partially on the map side;
that is what keeps a hot key (a giant order or seller) from landing whole in
one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktlens.functions import (
    avg_rounded,
    cents,
    clean_text,
    count_where,
    day_of,
    days_between,
    delivery_status,
    money_sum,
    month_of,
    pct,
    rounded_quotient,
    string_set_agg,
)
from mktlens.functions.status import LATE, ON_TIME
from mktlens.operators import LEAST_ROWS, split_hot, totals_from

# ------------------------------------------------------------------ M1


def _summed_items(items: DataFrame) -> DataFrame:
    """The order summary in two stages. Each item stands twice, under its product
    (with its measures) and under its seller; rows of one order and id become
    one, and then the rows of an order are counted and summed."""
    of_product = F.col("of_product")
    measures = ("item_price", "freight_value", "item_total_value")
    twice = items.select("order_id", "product_id", "seller_id", *measures, F.explode(F.array(F.lit(True), F.lit(False))).alias("of_product"))
    ids = (
        twice.withColumn("id", F.when(of_product, F.col("product_id")).otherwise(F.col("seller_id")))
        .groupBy("order_id", "of_product", "id")
        .agg(F.count("*").alias("n"), *[money_sum(F.when(of_product, F.col(c))).alias(c) for c in measures])
    )
    total = lambda c: money_sum(F.when(of_product, F.col(c)))
    return ids.groupBy("order_id").agg(
        F.sum(F.when(of_product, F.col("n"))).cast("bigint").alias("item_count"),
        F.count(F.when(of_product, F.col("id"))).cast("bigint").alias("product_count"),
        F.count(F.when(~of_product, F.col("id"))).cast("bigint").alias("seller_count"),
        total("item_price").alias("product_value"),
        total("freight_value").alias("freight_value"),
        total("item_total_value").alias("item_total_value"),
    )


def regular_item_summary(items: DataFrame) -> DataFrame:
    """``order_item_summary`` of orders that one task can read: items travel
    once, by order; both stages work behind that exchange."""
    return _summed_items(items.repartition("order_id"))


def crowded_item_summary(items: DataFrame) -> DataFrame:
    """``order_item_summary`` of crowded orders: rows travel by order and id, so
    an order is spread over all tasks, each of which sends on one row of it."""
    return _summed_items(items)


def order_item_summary(items: DataFrame, least: int = LEAST_ROWS) -> DataFrame:
    """Per order: item rows, distinct products and sellers, money sums.

    Both distinct counts are exact and hold no set. Orders with a large share of
    all items (``split_hot``) take the plan that splits them; all others keep
    the one that moves an item once."""
    regular, crowded = split_hot(items, "order_id", least)
    return regular_item_summary(regular).unionByName(crowded_item_summary(crowded))


def order_payment_summary(payments: DataFrame) -> DataFrame:
    """Per order: payment rows, sorted distinct types, max instalments, value."""
    return payments.groupBy("order_id").agg(
        F.count("*").cast("bigint").alias("payment_record_count"),
        string_set_agg("payment_type").alias("payment_types"),
        F.max("payment_installments").alias("maximum_installments"),
        money_sum("payment_value").alias("payment_value"),
    )


def mart_orders(
    stg_orders: DataFrame,
    stg_items: DataFrame,
    stg_payments: DataFrame,
    customers: DataFrame,
    least: int = LEAST_ROWS,
) -> DataFrame:
    """Grain: order_id (23 columns).

    Orders meet customers first, while the row is still narrow; the joined
    rows are then shuffled once on order_id, where the summaries of regular
    orders already sit hash-partitioned by their own aggregation, so they join
    without another exchange. The summaries of crowded orders are at most
    ``MOST_HOT`` rows and are broadcast.
    """
    o = stg_orders.alias("o")
    c = customers.select(
        F.col("customer_id").alias("c_customer_id"), "customer_unique_id", "customer_city", "customer_state"
    )
    oc = o.join(c, F.col("o.customer_id") == F.col("c_customer_id"), "left")
    regular, crowded = split_hot(stg_items, "order_id", least)
    i = regular_item_summary(regular).alias("i")
    h = F.broadcast(crowded_item_summary(crowded)).alias("h")
    p = order_payment_summary(stg_payments).alias("p")
    j = (
        oc.join(i, F.col("o.order_id") == F.col("i.order_id"), "left")
        .join(p, F.col("o.order_id") == F.col("p.order_id"), "left")
        .join(h, F.col("o.order_id") == F.col("h.order_id"), "left")
    )
    of_items = lambda c: F.coalesce(F.col(f"i.{c}"), F.col(f"h.{c}"), F.lit(0)).alias(c)
    zero = F.lit(0)
    return j.select(
        F.col("o.order_id").alias("order_id"),
        F.col("o.customer_id").alias("customer_id"),
        F.col("customer_unique_id"),
        clean_text("customer_city").alias("customer_city"),
        F.col("customer_state"),
        F.col("o.order_status").alias("order_status"),
        F.col("o.purchase_date").alias("purchase_date"),
        F.col("o.purchase_month").alias("purchase_month"),
        F.col("o.order_purchase_timestamp").alias("order_purchase_timestamp"),
        F.col("o.order_delivered_customer_date").alias("order_delivered_customer_date"),
        F.col("o.order_estimated_delivery_date").alias("order_estimated_delivery_date"),
        of_items("item_count"),
        of_items("product_count"),
        of_items("seller_count"),
        of_items("product_value"),
        of_items("freight_value"),
        of_items("item_total_value"),
        F.coalesce(F.col("p.payment_record_count"), zero).alias("payment_record_count"),
        F.col("p.payment_types").alias("payment_types"),
        F.col("p.maximum_installments").alias("maximum_installments"),
        F.coalesce(F.col("p.payment_value"), zero).alias("payment_value"),
        days_between(day_of("o.order_delivered_customer_date"), F.col("o.purchase_date")).alias("delivery_days"),
        delivery_status("o.order_delivered_customer_date", "o.order_estimated_delivery_date").alias(
            "delivery_status"
        ),
    )


# ------------------------------------------------------------------ M2


def product_category(translation_english, category) -> F.Column:
    """English name, else original name, else ``unknown`` (each cleaned)."""
    return F.coalesce(clean_text(translation_english), clean_text(category), F.lit("unknown"))


def product_categories(products: DataFrame, translation: DataFrame) -> DataFrame:
    """(product_id, category) of every product row: a join of two dimensions,
    so no item row ever travels by category name."""
    p = products.select("product_id", "product_category_name").alias("p")
    t = translation.select(
        F.col("product_category_name").alias("t_name"), "product_category_name_english"
    ).alias("t")
    category = product_category(F.col("product_category_name_english"), F.col("p.product_category_name"))
    return p.join(t, F.col("p.product_category_name") == F.col("t_name"), "left").select(
        F.col("p.product_id").alias("p_product_id"), category.alias("category")
    )


def _pair_sums() -> list[F.Column]:
    return [
        F.count("*").cast("bigint").alias("item_count"),
        money_sum("item_price").alias("product_value"),
        money_sum("freight_value").alias("freight_value"),
        money_sum("item_total_value").alias("item_total_value"),
    ]


def order_seller_summary(stg_items: DataFrame, products: DataFrame, translation: DataFrame) -> DataFrame:
    """Per (order, seller): items, distinct products, money, sorted categories.

    Items meet the product's category on the raw product id (a product without
    one is ``unknown``). The distinct count is planned in two stages: items
    travel once, by order, seller and product, combined where they are read;
    what is left of a pair is combined again before it travels by its own key.
    A pair or an order with a third of all items is spread over all tasks.
    """
    c = product_categories(products, translation)
    items = stg_items.join(c, stg_items["product_id"] == c["p_product_id"], "left").select(
        "order_id",
        "seller_id",
        "product_id",
        "item_price",
        "freight_value",
        "item_total_value",
        F.coalesce("category", F.lit("unknown")).alias("category"),
    )
    return items.groupBy("order_id", "seller_id").agg(
        *_pair_sums(),
        F.count_distinct("product_id").cast("bigint").alias("product_count"),
        string_set_agg("category").alias("product_categories"),
    )


def order_seller_facts(stg_items: DataFrame, stg_orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """The measures of ``mart_order_seller`` without its dimensions: what the
    seller lifecycle and the seller KPIs need of it, one row per (order,
    seller). No products, categories or sellers are read. Items are combined
    where they are read and travel once, by order and seller; the pairs of an
    order meet it by a join, whose skew adaptive execution splits."""
    pairs = stg_items.groupBy("order_id", "seller_id").agg(*_pair_sums())
    o = stg_orders.select(
        "order_id",
        "purchase_date",
        delivery_status("order_delivered_customer_date", "order_estimated_delivery_date").alias("delivery_status"),
    )
    r = review_summary(reviews, rounded=True).select("order_id", "average_review_score")
    return pairs.join(o, "order_id", "left").join(r, "order_id", "left")


def review_summary(reviews: DataFrame, rounded: bool = True) -> DataFrame:
    """Per order: review rows, distinct review ids, average score.

    ``rounded=True`` rounds the average to 2 dp (order-seller mart);
    ``rounded=False`` keeps the raw double (delivery analysis).
    """
    score = F.col("review_score")
    avg = avg_rounded(score) if rounded else F.avg(score)
    return reviews.groupBy("order_id").agg(
        F.count("*").cast("bigint").alias("review_row_count"),
        F.count_distinct("review_id").cast("bigint").alias("review_count"),
        avg.alias("average_review_score"),
    )


def mart_order_seller(
    stg_items: DataFrame,
    products: DataFrame,
    translation: DataFrame,
    stg_orders: DataFrame,
    sellers: DataFrame,
    reviews: DataFrame,
) -> DataFrame:
    """Grain: (order_id, seller_id) (20 columns). Reviews repeat across the
    sellers of one order, so seller review figures are associations.

    Pairs meet their seller first and lie by order in the end: sums by seller
    over the mart are combined before they travel, and a seller with a third of
    all orders is in no single task."""
    os_ = order_seller_summary(stg_items, products, translation).alias("os")
    o = stg_orders.alias("o")
    s = sellers.select(F.col("seller_id").alias("s_seller_id"), "seller_city", "seller_state")
    r = review_summary(reviews, rounded=True).alias("r")
    j = (
        os_.join(s, F.col("os.seller_id") == F.col("s_seller_id"), "left")
        .join(o, F.col("os.order_id") == F.col("o.order_id"), "left")
        .join(r, F.col("os.order_id") == F.col("r.order_id"), "left")
    )
    return j.select(
        F.col("os.order_id").alias("order_id"),
        F.col("os.seller_id").alias("seller_id"),
        clean_text("seller_city").alias("seller_city"),
        F.col("seller_state"),
        F.col("o.order_status").alias("order_status"),
        F.col("o.purchase_date").alias("purchase_date"),
        F.col("o.purchase_month").alias("purchase_month"),
        F.col("o.order_delivered_customer_date").alias("order_delivered_customer_date"),
        F.col("o.order_estimated_delivery_date").alias("order_estimated_delivery_date"),
        F.col("os.item_count").alias("item_count"),
        F.col("os.product_count").alias("product_count"),
        F.col("os.product_value").alias("product_value"),
        F.col("os.freight_value").alias("freight_value"),
        F.col("os.item_total_value").alias("item_total_value"),
        F.col("os.product_categories").alias("product_categories"),
        F.col("r.review_row_count").alias("review_row_count"),
        F.col("r.review_count").alias("review_count"),
        F.col("r.average_review_score").alias("average_review_score"),
        days_between(day_of("o.order_delivered_customer_date"), F.col("o.purchase_date")).alias("delivery_days"),
        delivery_status("o.order_delivered_customer_date", "o.order_estimated_delivery_date").alias(
            "delivery_status"
        ),
    )


# ------------------------------------------------------------------ M3


def mart_marketing_funnel(funnel: DataFrame) -> DataFrame:
    """Grain: (contact_month, origin) (8 columns)."""
    won = F.col("is_won")
    return funnel.groupBy(month_of("first_contact_date").alias("contact_month"), F.col("origin")).agg(
        F.count("*").cast("bigint").alias("total_leads"),
        count_where(won).alias("won_leads"),
        count_where(~won).alias("not_won_leads"),
        F.count_distinct("seller_id").cast("bigint").alias("closed_seller_count"),
        pct(F.count_if(won), F.count("*")).alias("conversion_rate_pct"),
        avg_rounded(F.when(won, F.col("days_to_close"))).alias("average_days_to_close"),
    )


# ------------------------------------------------------------------ M4


def seller_daily_activity(order_seller: DataFrame) -> DataFrame:
    """Order-seller rows pre-aggregated to (seller_id, purchase_date).

    This is the build side of the post-win join. A seller contributes at most
    one row per calendar day, so even a seller holding a third of all orders
    ships a bounded number of rows to the join, and all its sums are combined
    on the map side before any shuffle. The input has one row per (order,
    seller), so ``orders`` counts rows; an order has a single purchase date, so
    summing it over days gives the distinct post-win orders.
    """
    status = F.col("delivery_status")
    score_h = cents("average_review_score")
    return order_seller.groupBy("seller_id", "purchase_date").agg(
        F.count("*").cast("bigint").alias("orders"),
        F.sum("item_count").alias("items"),
        money_sum("product_value").alias("product_value"),
        money_sum("freight_value").alias("freight_value"),
        F.sum(score_h).alias("score_hundredths"),
        F.count(score_h).alias("scored_rows"),
        count_where(status == ON_TIME).alias("on_time"),
        count_where(status == LATE).alias("late"),
    )


def post_win_join(won_leads: DataFrame, daily: DataFrame) -> DataFrame:
    """Won lead LEFT JOIN seller activity on seller_id and purchase on or
    after the win day.

    The date test stays in the ON clause so leads without post-win sales keep
    their row. Spark plans it as an equi-join on seller_id with the date test
    as a residual predicate (no nested loop).
    """
    w = won_leads.alias("w")
    d = daily.alias("d")
    cond = (F.col("w.seller_id") == F.col("d.seller_id")) & (F.col("d.purchase_date") >= F.col("w.won_day"))
    return w.join(d, cond, "left")


def post_win_days(won_leads: DataFrame, daily: DataFrame) -> DataFrame:
    """Per (mql_id, purchase_date) of ``post_win_join``: orders and product value.

    ``daily`` has at most one row per seller and day, so a lead whose deals are
    all alike meets a day once, and its rows leave the join as they are,
    weighted by the number of those deals. Only the pairs of a lead won by
    several sellers or on several days are summed."""
    win = F.struct("seller_id", "won_day")
    leads = won_leads.groupBy("mql_id").agg(F.count("*").alias("m"), F.min(win).alias("least"), F.max(win).alias("most"))
    alike = F.col("least").eqNullSafe(F.col("most"))
    one = leads.where(alike).select("mql_id", "least.seller_id", "least.won_day", "m")
    several = leads.where(~alike).select(F.col("mql_id").alias("of_lead"))
    many = won_leads.join(several, F.col("mql_id").eqNullSafe(F.col("of_lead")), "left_semi")
    zero = F.lit(0).cast("bigint")
    once = post_win_join(one, daily).select(
        F.col("w.mql_id").alias("mql_id"),
        F.col("d.purchase_date").alias("purchase_date"),
        F.coalesce(F.col("d.orders") * F.col("w.m"), zero).alias("orders"),
        (F.col("d.product_value") * F.col("w.m")).cast("decimal(38,2)").alias("product_value"),
    )
    summed = (
        post_win_join(many, daily)
        .groupBy(F.col("w.mql_id").alias("mql_id"), F.col("d.purchase_date").alias("purchase_date"))
        .agg(
            F.coalesce(F.sum("d.orders"), zero).alias("orders"),
            F.sum("d.product_value").cast("decimal(38,2)").alias("product_value"),
        )
    )
    return once.unionByName(summed)


def seller_activity(funnel: DataFrame, order_seller: DataFrame) -> DataFrame:
    """Per won lead (mql_id, seller_id): post-win sales, reviews, delivery.

    Won funnel rows are first collapsed to (mql_id, seller_id, won_day) with a
    multiplicity, then get the totals of the seller's days from the win on
    (``totals_from``: no deal is paired with days). Sums are weighted by the
    multiplicity (a duplicated deal counts its sales twice, as a plain join
    would), while the distinct order count takes the widest window of the
    group (the earliest win day), as a distinct count over the join would.
    """
    won = (
        funnel.where(F.col("is_won"))
        .groupBy("mql_id", "seller_id", day_of("won_date").alias("won_day"))
        .agg(F.count("*").cast("bigint").alias("m"))
    )
    sums = ["orders", "items", "product_value", "freight_value", "score_hundredths", "scored_rows", "on_time", "late"]
    per_window = totals_from(won, seller_daily_activity(order_seller), "seller_id", "won_day", "purchase_date", sums, least=False)
    m = F.col("m")
    zero = F.lit(0).cast("bigint")
    # COUNT and COUNTIF are 0 over no matching rows; SUM, MIN and AVG are NULL
    on_time = F.coalesce(F.sum(F.col("on_time") * m), zero)
    late = F.coalesce(F.sum(F.col("late") * m), zero)
    return per_window.groupBy("mql_id", "seller_id").agg(
        F.min("first_day").alias("first_post_win_order_date"),
        F.coalesce(F.max("orders"), zero).alias("post_win_order_count"),
        F.sum(F.col("items") * m).alias("post_win_item_count"),
        F.sum(F.col("product_value") * m).cast("decimal(38,2)").alias("post_win_product_value"),
        F.sum(F.col("freight_value") * m).cast("decimal(38,2)").alias("post_win_freight_value"),
        rounded_quotient(F.sum(F.col("score_hundredths") * m), F.sum(F.col("scored_rows") * m) * 100).alias(
            "average_review_score"
        ),
        on_time.alias("on_time_order_count"),
        late.alias("late_order_count"),
        pct(on_time, on_time + late).alias("on_time_delivery_rate_pct"),
    )


def mart_seller_lifecycle(funnel: DataFrame, order_seller: DataFrame) -> DataFrame:
    """Grain: won lead (23 columns)."""
    f = funnel.where(F.col("is_won")).alias("f")
    a = seller_activity(funnel, order_seller).alias("a")
    j = f.join(a, F.col("f.mql_id") == F.col("a.mql_id"), "left")
    first = F.col("a.first_post_win_order_date")
    zero = F.lit(0)
    activated = first.isNotNull()
    return j.select(
        F.col("f.mql_id").alias("mql_id"),
        F.col("f.seller_id").alias("seller_id"),
        F.col("f.first_contact_date").alias("first_contact_date"),
        month_of("f.first_contact_date").alias("contact_month"),
        F.col("f.origin").alias("origin"),
        F.col("f.won_date").alias("won_date"),
        F.col("f.days_to_close").alias("days_to_close"),
        F.col("f.business_segment").alias("business_segment"),
        F.col("f.lead_type").alias("lead_type"),
        F.col("f.lead_behaviour_profile").alias("lead_behaviour_profile"),
        F.col("f.business_type").alias("business_type"),
        first.alias("first_post_win_order_date"),
        F.when(activated, days_between(first, day_of("f.won_date"))).alias("days_to_first_sale"),
        F.coalesce(F.col("a.post_win_order_count"), zero).cast("bigint").alias("post_win_order_count"),
        F.coalesce(F.col("a.post_win_item_count"), zero).cast("bigint").alias("post_win_item_count"),
        F.coalesce(F.col("a.post_win_product_value"), zero).alias("post_win_product_value"),
        F.coalesce(F.col("a.post_win_freight_value"), zero).alias("post_win_freight_value"),
        F.col("a.average_review_score").alias("average_review_score"),
        F.coalesce(F.col("a.on_time_order_count"), zero).cast("bigint").alias("on_time_order_count"),
        F.coalesce(F.col("a.late_order_count"), zero).cast("bigint").alias("late_order_count"),
        F.col("a.on_time_delivery_rate_pct").alias("on_time_delivery_rate_pct"),
        activated.alias("is_activated"),
        F.when(activated, "activated").otherwise("not_activated").alias("activation_status"),
    )


# ------------------------------------------------------------------ checks


def mart_orders_check(m1: DataFrame) -> DataFrame:
    """Mart rows vs distinct orders (one row per order)."""
    return m1.agg(
        F.count("*").cast("bigint").alias("mart_rows"),
        F.count_distinct("order_id").cast("bigint").alias("unique_orders"),
    )


def mart_order_seller_check(m2: DataFrame) -> DataFrame:
    """Mart rows vs distinct (order, seller) pairs, and distinct sellers."""
    return m2.agg(
        F.count("*").cast("bigint").alias("mart_rows"),
        F.count_distinct("order_id", "seller_id").cast("bigint").alias("unique_order_seller_pairs"),
        F.count_distinct("seller_id").cast("bigint").alias("seller_count"),
    )


def mart_marketing_funnel_check(m3: DataFrame) -> DataFrame:
    """Funnel mart totals (must equal the lead-level view)."""
    return m3.agg(
        F.sum("total_leads").cast("bigint").alias("total_leads"),
        F.sum("won_leads").cast("bigint").alias("won_leads"),
    )


def mart_seller_lifecycle_check(m4: DataFrame) -> DataFrame:
    """Closed leads, activated sellers, activation %."""
    act = F.col("is_activated")
    return m4.agg(
        F.count("*").cast("bigint").alias("closed_leads"),
        count_where(act).alias("activated_sellers"),
        pct(F.count_if(act), F.count("*")).alias("closed_to_activation_rate_pct"),
    )
