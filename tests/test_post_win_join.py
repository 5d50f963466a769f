"""Post-win pairs of leads and days, summed only for leads won more than once."""

import datetime as dt
import random
from collections import defaultdict

from conftest import raw_frame

from mktlens.registry import QUERIES
from mktlens.sources.schemas import RAW_SCHEMAS

DAY = dt.datetime(2020, 1, 1)


def write(spark, at, deals, sales):
    """Raw tables at ``at``: deals (lead, seller, day), sales (seller, day, price)."""
    rows = {t: [] for t in RAW_SCHEMAS}
    when = lambda d: None if d is None else DAY + dt.timedelta(days=d, hours=9)
    rows["marketing_qualified_leads"] = [{"mql_id": m} for m in sorted({m for m, _, _ in deals} | {"cold"})]
    rows["closed_deals"] = [{"mql_id": m, "seller_id": s, "won_date": when(d)} for m, s, d in deals]
    for i, (seller, d, price) in enumerate(sales):
        rows["orders"].append({"order_id": f"o{i}", "customer_id": "c", "order_status": "x", "order_purchase_timestamp": when(d)})
        rows["order_items"].append(
            {"order_id": f"o{i}", "order_item_id": 1, "product_id": "p", "seller_id": seller, "price": price, "freight_value": 0.0}
        )
    for t, found in rows.items():
        raw_frame(spark, t, found).write.parquet(f"{at}/{t}.parquet")


def brute(deals, sales):
    out = defaultdict(lambda: [0, None])
    for m, s, d in deals:
        hits = [(e, p) for t, e, p in sales if t == s and d is not None and e is not None and e >= d]
        for e, p in hits or [(None, None)]:
            pair = out[m, None if e is None else (DAY + dt.timedelta(days=e)).date()]
            if p is not None:
                pair[0] += 1
                pair[1] = (pair[1] or 0) + p
    return sorted(((*k, n, v) for k, (n, v) in out.items()), key=str)


def test_pairs_match_all_deals_and_sales(spark, tmp_path):
    rng = random.Random(4)
    seller, day = lambda: rng.choice(["a", "a", "b", "c", None]), lambda: rng.choice([None, *range(20)])
    deals = [(f"m{i % 25}", seller(), day()) for i in range(40)]
    deals += deals[:6] + [("twice", "a", 3)] * 2 + [("thrice", None, 3)] * 3
    sales = [(seller() or "d", day(), float(rng.randint(1, 50))) for _ in range(80)]
    write(spark, tmp_path, deals, sales)
    got = QUERIES["post_win_join"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == brute(deals, sales)


def test_pairs_of_leads_won_once_are_not_gathered(spark, tmp_path):
    write(spark, tmp_path, [(f"m{i}", "ab"[i % 2], i) for i in range(10)], [("a", 5, 1.0), ("b", 8, 2.0)])
    df = QUERIES["post_win_join"](spark, str(tmp_path))
    assert df.count() and len(df.collect()) == 10
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert not any("HashAggregate(keys=[mql_id" in line and "purchase_date" in line for line in plan.splitlines())


def test_seller_sums_over_the_mart_are_combined_before_they_travel(spark, tmp_path):
    write(spark, tmp_path, [("m", "a", 0)], [("a", 5, 1.0)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = QUERIES["post_win_join"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    partial = [i for i, line in enumerate(lines) if "HashAggregate(keys=[seller_id" in line and "partial_" in line]
    assert partial and all("Exchange hashpartitioning(seller_id" in lines[i - 1] for i in partial)
