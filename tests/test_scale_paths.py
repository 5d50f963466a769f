"""Skewed input, the native raw-table path, and view publishing."""

import datetime as dt
import os
import tempfile

from conftest import Frames, raw_frame
from pyspark.sql import functions as F

from mktlens.plans import marts
from mktlens.plans.warehouse import Warehouse
from mktlens.sources import load_raw

SF = "/root/testdata/sf0.001"


def test_hot_seller_is_bounded_and_correct(spark):
    # one seller holds far more than a third of all order-seller rows
    orders, items = [], []
    for k in range(300):
        oid = f"o{k}"
        orders.append({"order_id": oid, "customer_id": "c", "order_purchase_timestamp": dt.datetime(2020, 1, 1 + k % 10, 9)})
        items.append({"order_id": oid, "order_item_id": 1, "product_id": "p", "seller_id": "hot" if k % 4 else f"s{k}", "price": 1.0, "freight_value": 0.0})
    deals = [{"mql_id": "m1", "seller_id": "hot", "won_date": dt.datetime(2020, 1, 5)}]
    leads = [{"mql_id": "m1", "origin": "x"}]
    tables = {
        "orders": orders, "order_items": items, "order_payments": [], "order_reviews": [], "customers": [],
        "sellers": [], "products": [], "product_category_translation": [], "marketing_qualified_leads": leads,
        "closed_deals": deals,
    }
    w = Warehouse(Frames(spark, **{t: raw_frame(spark, t, r) for t, r in tables.items()}))
    daily = marts.seller_daily_activity(w.order_seller_facts).where(F.col("seller_id") == "hot")
    assert daily.count() == 10  # one row per calendar day, not per order
    row = w.mart_seller_lifecycle.first()
    expect = sum(1 for k in range(300) if k % 4 and 1 + k % 10 >= 5)
    assert row.post_win_order_count == expect and float(row.post_win_product_value) == expect


def test_native_parquet_tables_give_same_results(spark):
    raw = load_raw(spark, SF)
    d = tempfile.mkdtemp(prefix="mktlens-native-")
    for t in raw:
        raw[t].write.parquet(os.path.join(d, f"{t}.parquet"))
    native = load_raw(spark, d)
    assert native.native and set(native) >= set(raw)
    a = Warehouse(raw).acquisition_channel_quality.orderBy("origin").collect()
    b = Warehouse(native).acquisition_channel_quality.orderBy("origin").collect()
    assert a == b


def test_publish_registers_views(spark):
    w = Warehouse.at(spark, SF)
    names = w.publish("t_")
    assert "t_mart_orders" in names
    n = spark.sql("SELECT count(*) AS n FROM t_mart_orders").first().n
    assert n == w.mart_orders.count()


def test_materialized_views_read_back(spark):
    w = Warehouse.at(spark, SF)
    before = w.mart_marketing_funnel.orderBy("contact_month", "origin").collect()
    w2 = Warehouse.at(spark, SF).materialized(("stg_marketing_funnel",))
    assert w2.mart_marketing_funnel.orderBy("contact_month", "origin").collect() == before


def test_distributed_ranks_match_windows(spark):
    from mktlens.operators import rank_desc_window
    from mktlens.plans.analysis import seller_activation_performance

    m4 = Warehouse.at(spark, "/root/testdata/sf0.01").mart_seller_lifecycle
    cols = ["mql_id", "overall_product_value_rank", "origin_product_value_rank", "overall_order_count_rank"]
    got = seller_activation_performance(m4)
    base = got.drop(*cols[1:])
    pv, n = "post_win_product_value", "post_win_order_count"
    want = rank_desc_window(base, pv, cols[1])
    want = rank_desc_window(want, pv, cols[2], ["origin"])
    want = rank_desc_window(want, n, cols[3])
    a = got.select(*cols).orderBy("mql_id").collect()
    assert a == want.select(*cols).orderBy("mql_id").collect() and len(a) > 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan, *columns):
    """Hash exchanges on exactly these columns."""
    import re

    names = r", ".join(rf"{c}#\d+L?" for c in columns)
    return len(re.findall(rf"hashpartitioning\({names}, \d+\)", plan))


def test_plans_at_scale(spark):
    """With nothing broadcast: items travel once by order (or spread, if the
    order is crowded), never by category, and hot sellers are combined before
    their exchange. No set of ids is held anywhere."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        w = Warehouse.at(spark, SF)
        m1 = _plan(w.mart_orders)
        assert "collect_set(product_id" not in m1 and "collect_set(seller_id" not in m1
        regular = _plan(marts.regular_item_summary(w.stg_order_items))
        assert regular.count("Exchange hashpartitioning") == _exchanges(regular, "order_id") == 1
        assert regular.index("Generate") < regular.index("Exchange")  # items stand twice behind the exchange only
        crowded = _plan(marts.crowded_item_summary(w.stg_order_items))
        assert crowded.count("Exchange hashpartitioning") == 2 and _exchanges(crowded, "order_id") == 1
        summary = _plan(marts.order_seller_summary(w.stg_order_items, w.raw["products"], w.raw["product_category_translation"]))
        assert "Expand" not in summary and "collect_set(product_id" not in summary
        # an order is spread by seller and product: items met their product, and stay where it is
        assert not _exchanges(summary, "order_id") and _exchanges(summary, "order_id", "seller_id") == 1
        assert _exchanges(summary, "product_category_name") <= 1  # products, not items
        facts = _plan(w.order_seller_facts)
        pairs = facts.index("hashpartitioning(order_id#", 0), facts.index("partial_sum")
        assert _exchanges(facts, "order_id", "seller_id") == 1 and pairs[0] < pairs[1]  # combined, then by order
        m4 = _plan(w.mart_seller_lifecycle)
        assert "part.parquet" not in m4 and "supplier.parquet, " not in m4 and "p_type" not in m4 and "n_name" not in m4
        daily = _plan(marts.seller_daily_activity(w.order_seller_facts))
        top = daily.index("hashpartitioning(seller_id")
        assert "partial_sum" in daily[top : top + 400] or "partial_count" in daily[top : top + 400]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _crowded(spark):
    """One order with a third of all items, one with a single seller, and more."""
    items = []
    for k in range(900):
        if k < 300:
            item = ("hot", f"p{k % 70}", f"s{k % 40}")
        elif k < 500:
            item = ("one seller", f"p{k % 30}", "s1")
        else:
            item = (f"o{k // 3}", f"p{k % 5}", f"s{k % 2}")
        order, product, seller = item
        items.append({"order_id": order, "order_item_id": k, "product_id": product, "seller_id": seller, "price": k / 4, "freight_value": 0.5})
    items += [{"order_id": "hot", "order_item_id": 1, "product_id": None, "seller_id": "s1", "price": 1.0, "freight_value": 0.0}]
    orders = [{"order_id": o, "customer_id": "c", "order_purchase_timestamp": dt.datetime(2020, 1, 2, 9)} for o in sorted({i["order_id"] for i in items})]
    empty = ("order_payments", "order_reviews", "customers", "sellers", "products", "product_category_translation")
    tables = {"orders": orders, "order_items": items, **{t: [] for t in empty}}
    return items, Warehouse(Frames(spark, **{t: raw_frame(spark, t, r) for t, r in tables.items()}))


def test_a_crowded_order_is_split_and_correct(spark):
    from mktlens.operators import hot_keys, split_hot

    rows, w = _crowded(spark)
    items = w.stg_order_items
    # staging keeps the rows it keeps; the expectation is built from those
    kept = [r.asDict() for r in items.collect()]
    assert len(kept) > 800
    want = {}
    for r in kept:
        want.setdefault(r["order_id"], []).append(r)
    expect = sorted(
        (
            o,
            len(rs),
            len({r["product_id"] for r in rs} - {None}),
            len({r["seller_id"] for r in rs} - {None}),
            sum(r["item_price"] for r in rs),
        )
        for o, rs in want.items()
    )
    cols = ["order_id", "item_count", "product_count", "seller_count", "product_value"]
    for least in (100, 10**6):  # two crowded orders, and none
        regular, crowded = split_hot(items, "order_id", least)
        assert crowded.select("order_id").distinct().count() == (2 if least == 100 else 0)
        assert regular.count() + crowded.count() == len(kept)
        got = marts.order_item_summary(items, least).select(*cols)
        assert sorted(map(tuple, got.collect())) == expect
        m1 = marts.mart_orders(w.stg_orders, items, w.stg_order_payments, w.raw["customers"], least)
        assert sorted(map(tuple, m1.select(*cols).collect())) == expect
    pairs = {}
    for r in kept:
        pairs.setdefault((r["order_id"], r["seller_id"]), []).append(r)
    got = w.mart_order_seller.select("order_id", "seller_id", "item_count", "product_count", "product_value").collect()
    assert sorted(map(tuple, got)) == sorted(
        (*k, len(rs), len({r["product_id"] for r in rs} - {None}), sum(r["item_price"] for r in rs)) for k, rs in pairs.items()
    )
    assert hot_keys(items.where("false"), "order_id").count() == 0
    nulls = items.select(F.lit(None).cast("string").alias("k"))
    assert split_hot(nulls, "k", 10)[1].count() == nulls.count()


def test_build_warehouse_writes_layers_and_passes_gate(spark):
    from mktlens.plans.run import build_warehouse, published

    out = tempfile.mkdtemp(prefix="mktlens-build-")
    assert published(spark, out) == {}
    paths = build_warehouse(spark, SF, out, schemas=True)
    assert published(spark, out) == paths
    q2 = spark.read.parquet(paths["final_kpi_validation"])
    assert q2.where("check_status = 'PASS'").count() == 6
    a1 = spark.read.parquet(paths["acquisition_channel_quality"]).orderBy("origin").collect()
    assert a1 == Warehouse.at(spark, SF).acquisition_channel_quality.orderBy("origin").collect()
    m1 = spark.table("marts.mart_orders")
    assert m1.columns == Warehouse.at(spark, SF).mart_orders.columns
    assert m1.count() == spark.read.parquet(paths["mart_orders"]).count()
    assert any(n.startswith("purchase_month=") for n in os.listdir(paths["mart_orders"]))


def test_failed_gate_leaves_the_published_tables(spark):
    import pytest

    from mktlens.plans.run import QualityGateFailed, build_warehouse, published

    src = tempfile.mkdtemp(prefix="mktlens-src-")
    raw = load_raw(spark, SF)
    for t in raw:
        raw[t].write.parquet(os.path.join(src, f"{t}.parquet"))
    out = tempfile.mkdtemp(prefix="mktlens-gate-")
    good = build_warehouse(spark, src, out)
    before = spark.read.parquet(good["mart_orders"]).count()
    # a seller that sells nothing fails the marketplace_sellers check
    extra = raw["sellers"].limit(1).withColumn("seller_id", F.lit("idle"))
    extra.write.mode("append").parquet(os.path.join(src, "sellers.parquet"))
    with pytest.raises(QualityGateFailed, match="marketplace_sellers"):
        build_warehouse(spark, src, out)
    assert published(spark, out) == good
    assert spark.read.parquet(published(spark, out)["mart_orders"]).count() == before


def test_checks_compare_what_the_writes_observed(spark, monkeypatch):
    from mktlens.plans import quality, run

    out = tempfile.mkdtemp(prefix="mktlens-observe-")
    scan = quality.join_fanout_reconciliation
    want = sorted(map(tuple, Warehouse.at(spark, SF).join_fanout_reconciliation.collect()))

    def no_scan(*tables):
        raise AssertionError("scanned again")

    monkeypatch.setattr(quality, "join_fanout_reconciliation", no_scan)
    paths = run.build_warehouse(spark, SF, out)
    assert sorted(map(tuple, spark.read.parquet(paths["join_fanout_reconciliation"]).collect())) == want
    w = Warehouse.at(spark, SF)
    for r in spark.read.parquet(paths["staging_reconciliation"]).collect():
        assert (r["raw_rows"], r["staging_rows"]) == (w.raw[r["raw_table"]].count(), getattr(w, r["view"]).count())
    # totals that do not agree are looked up again, and only then believed
    totals = {v: {"rows": 1, **{c: 1 for c in quality.FANOUT_MEASURES.get(v, ())}} for v in run.GRAINS}
    totals["mart_orders"] = {**totals["mart_orders"], "rows": 2}
    monkeypatch.setattr(quality, "join_fanout_reconciliation", scan)
    assert sorted(map(tuple, run._fanout(spark, w, totals).collect())) == want


def test_a_stopped_publication_leaves_the_former_one(spark):
    from pyspark.sql import DataFrameWriter

    from mktlens.plans.run import POINTER, drop_old_runs, publish, published

    out = tempfile.mkdtemp(prefix="mktlens-pointer-")
    runs = []
    for n in range(4):
        run = os.path.join(out, f"run-{n:032x}")
        os.makedirs(os.path.join(run, "v"))
        runs.append({"v": f"{run}/v", "w": f"{run}/w"})
    assert published(spark, out) == {} and drop_old_runs(spark, out) == []
    assert publish(spark, out, runs[0]) == 1 and published(spark, out) == runs[0]
    # stopped before the commit: the folder is there, its file is not
    os.makedirs(os.path.join(out, POINTER, "version=2", "_temporary", "0"))
    assert published(spark, out) == runs[0]
    assert publish(spark, out, runs[1]) == 2 and published(spark, out) == runs[1]
    real = DataFrameWriter.parquet

    def stopped(self, path, *args, **kwargs):
        raise KeyboardInterrupt

    DataFrameWriter.parquet = stopped
    try:
        publish(spark, out, runs[2])
    except KeyboardInterrupt:
        pass
    finally:
        DataFrameWriter.parquet = real
    assert published(spark, out) == runs[1]
    assert publish(spark, out, runs[2]) == 3 and publish(spark, out, runs[2]) == 4
    assert drop_old_runs(spark, out, keep=1) == [os.path.dirname(runs[0]["v"]), os.path.dirname(runs[1]["v"])]
    assert published(spark, out) == runs[2] and os.path.isdir(os.path.dirname(runs[2]["v"]))
    assert not os.path.exists(runs[0]["v"]) and os.path.isdir(os.path.dirname(runs[3]["v"]))
