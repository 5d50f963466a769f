"""Derive the marketplace raw tables from the TPC-H-like test tables.

The test data ships ``orders lineitem customer supplier part nation region
events``; each raw marketplace table is a deterministic projection of one of
them. Every derivation is a narrow, partition-local projection (plus two
broadcast lookups of the 25-row nation and 5-row region tables), so adapter
cost grows linearly with the input and adds no shuffle of its own. Global
counts used by two rules are scalar subqueries, evaluated once per query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mktlens.sources.schemas import RAW_SCHEMAS


# Columns and types of the test tables the adapters read.
TEST_SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan a test table with its declared schema: no schema-inference job."""
    return spark.read.schema(TEST_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _hours(ts: Column, n: Column) -> Column:
    return F.timestamp_add("HOUR", n.cast("int"), ts.cast("timestamp_ntz"))


def _s(c: Column) -> Column:
    return c.cast("string")


def _conform(df: DataFrame, table: str) -> DataFrame:
    """Select the contract columns in contract order with contract types."""
    schema = RAW_SCHEMAS[table]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _null(table: str, column: str) -> Column:
    return F.lit(None).cast(RAW_SCHEMAS[table][column].dataType).alias(column)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    return _conform(
        o.select(
            _s(k).alias("order_id"),
            _s(F.col("o_custkey")).alias("customer_id"),
            F.when(status == "F", " Delivered ").when(status == "O", "SHIPPED").otherwise("canceled").alias("order_status"),
            _hours(F.col("o_orderdate"), k % 24).alias("order_purchase_timestamp"),
            _null("orders", "order_approved_at"),
            _null("orders", "order_delivered_carrier_date"),
            F.when(status != "P", _hours(F.col("o_orderdate"), (k % 23 + 5) * 24 + 13)).alias(
                "order_delivered_customer_date"
            ),
            _hours(F.col("o_orderdate"), (k % 11 + 10) * 24).alias("order_estimated_delivery_date"),
        ),
        "orders",
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    return _conform(
        li.select(
            _s(F.col("l_orderkey")).alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            _s(F.col("l_partkey")).alias("product_id"),
            _s(F.col("l_suppkey")).alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            F.col("l_extendedprice").alias("price"),
            (F.col("l_quantity") + F.col("l_tax")).alias("freight_value"),
        ),
        "order_items",
    )


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    first = o.where(k % 500 != 0).select(
        _s(k).alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), " Credit_Card ")
        .otherwise("BOLETO")
        .alias("payment_type"),
        (k % 11).alias("payment_installments"),
        F.col("o_totalprice").alias("payment_value"),
    )
    voucher = o.where(k % 5 == 1).select(
        _s(k).alias("order_id"),
        F.lit(2).alias("payment_sequential"),
        F.lit("voucher").alias("payment_type"),
        F.lit(1).alias("payment_installments"),
        F.lit(12.5).alias("payment_value"),
    )
    return _conform(first.unionByName(voucher), "order_payments")


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events")
    n_orders = _read(spark, sf_dir, "orders").select(F.count("*")).scalar()
    order_span = F.floor(n_orders / 5).cast("bigint")
    e = F.col("event_id")
    return _conform(
        ev.where(F.col("event_type").isin("purchase", "view", "click")).select(
            F.concat(F.lit("r"), _s(F.floor(e / 2).cast("bigint"))).alias("review_id"),
            _s(e % order_span).alias("order_id"),
            (F.floor(F.col("value")).cast("bigint") % 5 + 1).alias("review_score"),
            _null("order_reviews", "review_comment_title"),
            _null("order_reviews", "review_comment_message"),
            F.col("ts").alias("review_creation_date"),
            _null("order_reviews", "review_answer_timestamp"),
        ),
        "order_reviews",
    )


def _geo(spark: SparkSession, sf_dir: str, df: DataFrame, nation_key: str) -> DataFrame:
    nation = _read(spark, sf_dir, "nation")
    region = _read(spark, sf_dir, "region")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")
    # nation x region is 25 rows by the TPC-H definition: a proven bound.
    return df.join(F.broadcast(geo), df[nation_key] == geo.n_nationkey)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _geo(spark, sf_dir, _read(spark, sf_dir, "customer"), "c_nationkey")
    k = F.col("c_custkey")
    return _conform(
        c.select(
            _s(k).alias("customer_id"),
            F.concat(F.lit("u"), _s(k % 1400)).alias("customer_unique_id"),
            _s(k % 900 + 10000).alias("customer_zip_code_prefix"),
            F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("customer_city"),
            F.col("r_name").alias("customer_state"),
        ),
        "customers",
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _geo(spark, sf_dir, _read(spark, sf_dir, "supplier"), "s_nationkey")
    k = F.col("s_suppkey")
    return _conform(
        s.select(
            _s(k).alias("seller_id"),
            _s(k % 900 + 10000).alias("seller_zip_code_prefix"),
            F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("seller_city"),
            F.col("r_name").alias("seller_state"),
        ),
        "sellers",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return _conform(
        p.select(
            _s(k).alias("product_id"),
            F.when(k % 20 != 0, F.lower(F.col("p_type"))).alias("product_category_name"),
            F.char_length(F.col("p_name")).alias("product_name_lenght"),
            _null("products", "product_description_lenght"),
            _null("products", "product_photos_qty"),
            (F.col("p_size") * 100).alias("product_weight_g"),
            F.col("p_size").alias("product_length_cm"),
            _null("products", "product_height_cm"),
            _null("products", "product_width_cm"),
        ),
        "products",
    )


def product_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    return _conform(
        p.where(F.col("p_type") != "PROMO")
        .select(
            F.lower(F.col("p_type")).alias("product_category_name"),
            F.concat(F.lit(" EN_"), F.col("p_type")).alias("product_category_name_english"),
        )
        .distinct(),
        "product_category_translation",
    )


def marketing_qualified_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    bucket = k % 10
    return _conform(
        c.select(
            F.concat(F.lit("m"), _s(k)).alias("mql_id"),
            F.date_add(F.lit("1996-01-01").cast("date"), (k % 700).cast("int")).alias("first_contact_date"),
            F.concat(F.lit("lp"), _s(k % 13)).alias("landing_page_id"),
            F.when(bucket == 0, F.lit(None).cast("string"))
            .when(bucket == 1, F.lit("  "))
            .when(bucket == 2, F.concat(F.lit(" "), seg, F.lit(" ")))
            .otherwise(F.lower(seg))
            .alias("origin"),
        ),
        "marketing_qualified_leads",
    )


def closed_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    n_sellers = _read(spark, sf_dir, "supplier").select(F.count("*")).scalar()
    k = F.col("c_custkey")
    base = F.lit("1996-01-01 10:00:00").cast("timestamp_ntz")
    return _conform(
        c.where((k % 7).isin(0, 3)).select(
            F.concat(F.lit("m"), _s(k)).alias("mql_id"),
            _s(k % (n_sellers * 2)).alias("seller_id"),
            F.concat(F.lit("sdr"), _s(k % 9)).alias("sdr_id"),
            F.concat(F.lit("sr"), _s(k % 11)).alias("sr_id"),
            F.when(k % 5 == 0, F.lit("2001-09-01 10:00:00").cast("timestamp_ntz"))
            .otherwise(_hours(base, (k % 700 + k % 60) * 24))
            .alias("won_date"),
            F.concat(F.lit(" "), F.col("c_mktsegment")).alias("business_segment"),
            F.when(k % 3 == 0, "Online_Big ").when(k % 3 == 1, "industry").alias("lead_type"),
            F.when(k % 4 == 0, "Cat").when(k % 4 == 1, "wolf ").alias("lead_behaviour_profile"),
            _null("closed_deals", "has_company"),
            _null("closed_deals", "has_gtin"),
            _null("closed_deals", "average_stock"),
            F.when(k % 2 == 0, "Reseller").otherwise("manufacturer").alias("business_type"),
            _null("closed_deals", "declared_product_catalog_size"),
            _null("closed_deals", "declared_monthly_revenue"),
        ),
        "closed_deals",
    )


# The test table that each adapter's rows come from.
SOURCE_OF = {
    "closed_deals": "customer",
    "customers": "customer",
    "marketing_qualified_leads": "customer",
    "order_items": "lineitem",
    "order_payments": "orders",
    "order_reviews": "events",
    "orders": "orders",
    "product_category_translation": "part",
    "products": "part",
    "sellers": "supplier",
}

ADAPTERS = {
    "closed_deals": closed_deals,
    "customers": customers,
    "marketing_qualified_leads": marketing_qualified_leads,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "orders": orders,
    "product_category_translation": product_category_translation,
    "products": products,
    "sellers": sellers,
}
