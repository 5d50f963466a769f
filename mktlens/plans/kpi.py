"""KPI and dimension layer for the reporting model.

Each KPI is ``groupBy(*dims).agg(expr)`` over a mart, so a report filter
("current filter context") becomes the ``dims`` argument. Dimensions are
derived from the data (never typed in) and are small by construction.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mktlens.functions import (
    avg_rounded,
    avg_rounded_hundredths,
    cents,
    clean_text,
    count_where,
    day_of,
    month_of,
    pct,
    round_double,
    rounded_quotient,
)
from mktlens.functions.status import LATE, NOT_DELIVERED, ON_TIME
from mktlens.operators import totals_from
from mktlens.plans.marts import review_summary, seller_daily_activity


def _delivery_aggs(status: F.Column) -> list[F.Column]:
    on_time, late = F.count_if(status == ON_TIME), F.count_if(status == LATE)
    return [
        count_where(status != NOT_DELIVERED).alias("delivered_orders"),
        on_time.cast("bigint").alias("on_time_orders"),
        late.cast("bigint").alias("late_orders"),
        pct(on_time, on_time + late).alias("on_time_rate_pct"),
    ]


def kpi_monthly(
    m1: DataFrame,
    stg_items: DataFrame,
    stg_orders: DataFrame,
    reviews: DataFrame,
    dims: Sequence[str] = ("purchase_month",),
) -> DataFrame:
    """Executive trend, by purchase month unless ``dims`` names other columns
    of the order mart: orders, product GMV (no freight), AOV = GMV / distinct
    orders, active sellers, delivery, reviews."""
    dims = list(dims)
    r = review_summary(reviews, rounded=False).select(
        "order_id", F.col("average_review_score").alias("order_review_score")
    )
    base = m1.join(r, "order_id", "left")
    score = F.col("order_review_score")
    gmv = F.sum("product_value")
    per = base.groupBy(*dims).agg(
        F.count("*").cast("bigint").alias("order_count"),
        count_where(F.col("item_count") > 0).alias("orders_with_items"),
        gmv.alias("product_gmv"),
        rounded_quotient(cents(gmv), F.count("*") * 100).alias("aov"),
        *_delivery_aggs(F.col("delivery_status")),
        count_where(score.isNotNull()).alias("reviewed_orders"),
        round_double(F.avg(score)).alias("average_review_score"),
    )
    # active sellers: distinct (group, seller) first, then a count per group
    orders = stg_orders.select("order_id", "purchase_month")
    if dims != ["purchase_month"]:
        orders = m1.select("order_id", *dims)
    sellers = (
        stg_items.select("order_id", "seller_id")
        .join(orders, "order_id")
        .select(*dims, "seller_id")
        .distinct()
        .groupBy(*[F.col(d).alias(f"s_{d}") for d in dims])
        .agg(F.count("*").cast("bigint").alias("active_sellers"))
    )
    same = [per[d].eqNullSafe(sellers[f"s_{d}"]) for d in dims]
    return per.join(sellers, reduce(and_, same), "left").select(
        *dims,
        "order_count",
        "orders_with_items",
        "product_gmv",
        "aov",
        F.coalesce(F.col("active_sellers"), F.lit(0)).cast("bigint").alias("active_sellers"),
        "delivered_orders",
        "on_time_orders",
        "late_orders",
        "on_time_rate_pct",
        "reviewed_orders",
        "average_review_score",
    )


def kpi_contexts(
    m1: DataFrame,
    stg_items: DataFrame,
    reviews: DataFrame,
    dims: Sequence[str] = ("purchase_month", "customer_state"),
    contexts: Sequence[Sequence[str]] = (("purchase_month", "customer_state"), ("purchase_month",), ("customer_state",), ()),
) -> DataFrame:
    """The measures of ``kpi_monthly`` in several filter contexts at once, as
    (context, dims..., measures): ``context`` names the columns that a row is
    for, ``total`` for none; the other dims are NULL.

    Orders are read once, into the states of the finest cells (counts, sums of
    money and of scores), which are additive; grouping sets roll those few rows
    up. Active sellers are not additive: each distinct (cell, seller) is rolled
    up to the contexts, made distinct there and counted, in two stages, so a
    month with a third of all sellers is no single row's set.
    """
    dims = list(dims)
    full = (1 << len(dims)) - 1
    number = {c: full - sum(1 << (len(dims) - 1 - dims.index(d)) for d in c) for c in map(tuple, contexts)}
    context = F.coalesce(*[F.when(F.col("_set") == n, F.lit(", ".join(c) or "total")) for c, n in number.items()])
    r = review_summary(reviews, rounded=False).select("order_id", F.col("average_review_score").alias("score"))
    status, score = F.col("delivery_status"), F.col("score")
    cells = (
        m1.join(r, "order_id", "left")
        .groupBy(*dims)
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("item_count") > 0).alias("with_items"),
            F.sum("product_value").alias("gmv"),
            F.count_if(status != NOT_DELIVERED).alias("delivered"),
            F.count_if(status == ON_TIME).alias("on_time"),
            F.count_if(status == LATE).alias("late"),
            F.count(score).alias("reviewed"),
            F.sum(score.cast("decimal(20,12)")).alias("scores"),
        )
    )
    total = lambda c: F.sum(c).cast("bigint")
    rolled = cells.groupingSets([[F.col(d) for d in c] for c in contexts], *dims).agg(
        F.grouping_id().cast("int").alias("_set"),
        total("n").alias("order_count"),
        total("with_items").alias("orders_with_items"),
        F.sum("gmv").alias("product_gmv"),
        rounded_quotient(cents(F.sum("gmv")), F.sum("n") * 100).alias("aov"),
        total("delivered").alias("delivered_orders"),
        total("on_time").alias("on_time_orders"),
        total("late").alias("late_orders"),
        pct(F.sum("on_time"), F.sum("on_time") + F.sum("late")).alias("on_time_rate_pct"),
        total("reviewed").alias("reviewed_orders"),
        F.when(F.sum("reviewed") > 0, round_double(F.sum("scores").cast("double") / F.sum("reviewed"))).alias(
            "average_review_score"
        ),
    )
    sold = stg_items.select("order_id", "seller_id").join(m1.select("order_id", *dims), "order_id").select(*dims, "seller_id")
    sellers = (
        sold.where(F.col("seller_id").isNotNull())
        .distinct()
        .groupingSets([[*[F.col(d) for d in c], F.col("seller_id")] for c in contexts], *dims, "seller_id")
        .agg(F.shiftright(F.grouping_id(), 1).cast("int").alias("_of"))
        .groupBy("_of", *[F.col(d).alias(f"_{d}") for d in dims])
        .agg(F.count("*").alias("active_sellers"))
    )
    same = reduce(and_, [F.col(d).eqNullSafe(F.col(f"_{d}")) for d in dims], F.col("_set") == F.col("_of"))
    return rolled.join(sellers, same, "left").select(
        context.alias("context"),
        *dims,
        "order_count",
        "orders_with_items",
        "product_gmv",
        "aov",
        F.coalesce("active_sellers", F.lit(0)).cast("bigint").alias("active_sellers"),
        *[c for c in rolled.columns[rolled.columns.index("delivered_orders") :]],
    )


def kpi_channel(funnel: DataFrame, m4: DataFrame, dims: Sequence[str] = ("origin",)) -> DataFrame:
    """Leads, won leads, activated sellers and the two conversion rates."""
    dims = list(dims)
    leads = funnel.groupBy(*dims).agg(
        F.count("*").cast("bigint").alias("leads"), count_where(F.col("is_won")).alias("won_leads")
    )
    act = m4.groupBy(*dims).agg(count_where(F.col("is_activated")).alias("activated_sellers"))
    j = leads.join(act, dims, "left")
    activated = F.coalesce(F.col("activated_sellers"), F.lit(0)).cast("bigint")
    return j.select(
        *dims,
        "leads",
        "won_leads",
        activated.alias("activated_sellers"),
        pct(F.col("won_leads"), F.col("leads")).alias("lead_to_close_rate_pct"),
        pct(activated, F.col("won_leads")).alias("closed_to_activation_rate_pct"),
    )


def kpi_fulfilment(m1: DataFrame, reviews: DataFrame, dims: Sequence[str] = ("delivery_status",)) -> DataFrame:
    """Delivery days, freight and review outcome per fulfilment group."""
    dims = list(dims)
    r = review_summary(reviews, rounded=False).select(
        "order_id", F.col("average_review_score").alias("order_review_score")
    )
    base = m1.join(r, "order_id", "left")
    score = F.col("order_review_score")
    freight = F.sum("freight_value")
    reviewed = F.count_if(score.isNotNull())
    return base.groupBy(*dims).agg(
        F.count("*").cast("bigint").alias("order_count"),
        avg_rounded("delivery_days").alias("average_delivery_days"),
        freight.alias("freight_value"),
        rounded_quotient(cents(freight), F.count("*") * 100).alias("average_freight_per_order"),
        reviewed.cast("bigint").alias("reviewed_orders"),
        round_double(F.avg(score)).alias("average_review_score"),
        pct(F.count_if(score <= 2), reviewed).alias("low_review_rate_pct"),
    )


def kpi_seller(facts: DataFrame, sellers: DataFrame) -> DataFrame:
    """Seller performance by seller and geography (review figures are
    associations: an order's reviews repeat across its sellers). The facts are
    reduced to one row per seller before they meet the seller's geography."""
    status = F.col("delivery_status")
    on_time, late = F.count_if(status == ON_TIME), F.count_if(status == LATE)
    per = facts.groupBy("seller_id").agg(
        F.count("*").cast("bigint").alias("order_count"),
        F.sum("item_count").cast("bigint").alias("item_count"),
        F.sum("product_value").alias("product_gmv"),
        F.sum("freight_value").alias("freight_value"),
        on_time.cast("bigint").alias("on_time_orders"),
        late.cast("bigint").alias("late_orders"),
        pct(on_time, on_time + late).alias("on_time_rate_pct"),
        F.count("average_review_score").cast("bigint").alias("reviewed_orders"),
        avg_rounded_hundredths("average_review_score").alias("average_review_score"),
    )
    place = sellers.select("seller_id", clean_text("seller_city").alias("seller_city"), "seller_state")
    return per.join(place, "seller_id", "left").select("seller_id", "seller_city", "seller_state", *per.columns[1:])


def post_win_sales(funnel: DataFrame, facts: DataFrame) -> DataFrame:
    """Order-seller sales on or after the win day of a closed seller, by
    lead origin and purchase month (a seller with two won leads counts under
    both).

    No lead is paired with days. In the month of the win a lead gets the running
    total of its seller's days from the win on (``totals_from``). In a later
    month all leads of a seller and origin get the same total, so it is taken
    once and weighted by the leads won in the months before, a running count
    over the seller's months. Rows grow with leads plus days, and with the
    (origin, month) pairs of a seller, which are its rows of the result.
    """
    won = (
        funnel.where(F.col("is_won"))
        .groupBy("seller_id", "origin", day_of("won_date").alias("won_day"))
        .agg(F.count("*").alias("leads"))
        .where(F.col("seller_id").isNotNull() & F.col("won_day").isNotNull())
        .withColumn("month", month_of("won_day"))
    )
    sums = ("orders", "items", "product_value")
    daily = (
        seller_daily_activity(facts)
        .where(F.col("seller_id").isNotNull() & F.col("purchase_date").isNotNull())
        .select("seller_id", month_of("purchase_date").alias("month"), "purchase_date", *sums)
    )
    cell = F.struct("seller_id", "month").alias("cell")
    first = totals_from(won.withColumn("cell", cell), daily.withColumn("cell", cell), "cell", "won_day", "purchase_date", sums, least=False)
    first = first.where(F.col("first_day").isNotNull()).select("origin", "month", "leads", *sums)

    monthly = daily.groupBy("seller_id", "month").agg(*[F.sum(c).alias(c) for c in sums])
    origins = won.select("seller_id", "origin").distinct()
    sales = monthly.join(origins, "seller_id").select("seller_id", "origin", "month", F.lit(0).cast("bigint").alias("leads"), *sums)
    wins = won.groupBy("seller_id", "origin", "month").agg(F.sum("leads").alias("leads"))
    # A month's sales stand before its wins: they see the leads of earlier months.
    before = (
        Window.partitionBy("seller_id", "origin")
        .orderBy("month", F.col("orders").isNull().asc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    later = (
        sales.unionByName(wins, allowMissingColumns=True)
        .withColumn("leads", F.sum("leads").over(before))
        .where(F.col("orders").isNotNull() & (F.col("leads") > 0))
        .select("origin", "month", "leads", *sums)
    )
    times = F.col("leads")
    return first.unionByName(later).groupBy("origin", F.col("month").alias("purchase_month")).agg(
        F.sum(F.col("orders") * times).cast("bigint").alias("post_win_orders"),
        F.sum(F.col("items") * times).cast("bigint").alias("post_win_items"),
        F.sum((F.col("product_value") * times).cast("decimal(38,2)")).alias("post_win_product_value"),
    )


def top_seller_id(stg_items: DataFrame) -> F.Column:
    """The seller with most orders (ties: smallest id), as a scalar."""
    return (
        stg_items.select("order_id", "seller_id")
        .distinct()
        .groupBy("seller_id")
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), F.col("seller_id").asc())
        .limit(1)
        .select("seller_id")
        .scalar()
    )


def seller_detail(m2: DataFrame, seller_id: F.Column | str) -> DataFrame:
    """Drill-through: every order-seller row of one seller."""
    return m2.where(F.col("seller_id") == (F.lit(seller_id) if isinstance(seller_id, str) else seller_id))


def dim_date(stg_orders: DataFrame, funnel: DataFrame) -> DataFrame:
    """Calendar from the earliest to the latest date in the model
    (purchase, first contact, win). One row per day; the span is bounded by
    the calendar, not by the data volume."""
    bounds = (
        stg_orders.select(F.col("purchase_date").alias("d"))
        .unionByName(funnel.select(F.col("first_contact_date").alias("d")))
        .unionByName(funnel.select(day_of("won_date").alias("d")))
        .agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
        .where(F.col("lo").isNotNull())
    )
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    d = F.col("date")
    return days.select(
        d,
        F.year(d).cast("bigint").alias("year"),
        F.quarter(d).cast("bigint").alias("quarter"),
        F.month(d).cast("bigint").alias("month"),
        F.trunc(d, "month").alias("month_start"),
        (F.weekday(d) + 1).cast("bigint").alias("iso_day_of_week"),
        F.weekofyear(d).cast("bigint").alias("iso_week"),
    )


def dim_seller(sellers: DataFrame, deals: DataFrame, stg_items: DataFrame) -> DataFrame:
    """Sellers with cleaned geography, number of won leads and sales flag."""
    won = deals.groupBy("seller_id").agg(F.count("*").cast("bigint").alias("won_leads"))
    sold = stg_items.select("seller_id").distinct().withColumn("has_orders", F.lit(True))
    s = sellers.join(won, "seller_id", "left").join(sold, "seller_id", "left")
    return s.select(
        "seller_id",
        "seller_zip_code_prefix",
        clean_text("seller_city").alias("seller_city"),
        "seller_state",
        F.coalesce(F.col("won_leads"), F.lit(0)).cast("bigint").alias("won_leads"),
        F.coalesce(F.col("has_orders"), F.lit(False)).alias("has_orders"),
    )


def dim_origin(funnel: DataFrame) -> DataFrame:
    """Distinct acquisition origins with their lead counts."""
    return funnel.groupBy("origin").agg(F.count("*").cast("bigint").alias("lead_count"))
