"""Post-win sales by origin and month against all pairs of leads and days."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

from mktlens.plans import kpi

DAY = dt.date(2020, 1, 1)


def frames(spark, leads, facts):
    funnel = spark.createDataFrame(
        [(f"m{i}", s, o, d and dt.datetime.combine(d, dt.time(9)), won) for i, (s, o, d, won) in enumerate(leads)],
        "mql_id string, seller_id string, origin string, won_date timestamp_ntz, is_won boolean",
    )
    rows = [(f"o{i}", s, d, n, Decimal(v)) for i, (s, d, n, v) in enumerate(facts)]
    sold = spark.createDataFrame(
        rows, "order_id string, seller_id string, purchase_date date, item_count long, product_value decimal(18,2)"
    )
    return funnel, sold.selectExpr(
        "*", "CAST(0 AS DECIMAL(18,2)) AS freight_value", "CAST(NULL AS DOUBLE) AS average_review_score", "'x' AS delivery_status"
    )


def brute(leads, facts):
    orders, items, value = Counter(), Counter(), Counter()
    for s, o, won_day, won in leads:
        for seller, d, n, v in facts:
            if won and s is not None and s == seller and won_day and d and d >= won_day:
                key = (o, d.replace(day=1))
                orders[key] += 1
                items[key] += n
                value[key] += Decimal(v)
    return sorted(((*k, orders[k], items[k], value[k]) for k in orders), key=str)


def test_matches_all_pairs(spark):
    rng = random.Random(5)
    day = lambda: rng.choice([None, *[DAY + dt.timedelta(days=rng.randint(0, 120)) for _ in range(9)]])
    seller = lambda: rng.choice(["a", "a", "b", "c", None])
    leads = [(seller(), rng.choice(["x", "y", None]), day(), rng.random() < 0.8) for _ in range(80)]
    leads += leads[:7]
    facts = [(seller(), day(), rng.randint(0, 3), rng.randint(0, 99)) for _ in range(150)]
    for some_leads, some_facts in ((leads, facts), (leads[:1], facts), (leads, facts[:1]), ([], facts), (leads, [])):
        got = kpi.post_win_sales(*frames(spark, some_leads, some_facts)).collect()
        assert sorted(map(tuple, got), key=str) == brute(some_leads, some_facts)


def test_one_seller_with_ten_thousand_deals(spark):
    leads = [("s", "xyz"[i % 3], DAY + dt.timedelta(days=i % 300), True) for i in range(10_000)]
    facts = [("s", DAY + dt.timedelta(days=i), 1, i) for i in range(0, 320, 2)]
    df = kpi.post_win_sales(*frames(spark, leads, facts))
    want = Counter()
    for _, o, d, _ in leads:
        for _, e, n, _ in facts:
            if e >= d:
                want[o, e.replace(day=1)] += n
    assert {(r["origin"], r["purchase_month"]): r["post_win_orders"] for r in df.collect()} == want
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not any(">=" in line or "<" in line for line in joins)
