"""Raw input contract: the eleven marketplace tables.

Column lists, candidate keys and tracked join columns are fixed values of the
source contract. Spark types are the ones the SQL layer relies on.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
TS, DT = T.TimestampNTZType(), T.DateType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Column names and order of every raw table.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "customers": _schema(
        ("customer_id", S),
        ("customer_unique_id", S),
        ("customer_zip_code_prefix", S),
        ("customer_city", S),
        ("customer_state", S),
    ),
    "geolocation": _schema(
        ("geolocation_zip_code_prefix", S),
        ("geolocation_lat", D),
        ("geolocation_lng", D),
        ("geolocation_city", S),
        ("geolocation_state", S),
    ),
    "order_items": _schema(
        ("order_id", S),
        ("order_item_id", L),
        ("product_id", S),
        ("seller_id", S),
        ("shipping_limit_date", TS),
        ("price", D),
        ("freight_value", D),
    ),
    "order_payments": _schema(
        ("order_id", S),
        ("payment_sequential", L),
        ("payment_type", S),
        ("payment_installments", L),
        ("payment_value", D),
    ),
    "order_reviews": _schema(
        ("review_id", S),
        ("order_id", S),
        ("review_score", L),
        ("review_comment_title", S),
        ("review_comment_message", S),
        ("review_creation_date", TS),
        ("review_answer_timestamp", TS),
    ),
    "orders": _schema(
        ("order_id", S),
        ("customer_id", S),
        ("order_status", S),
        ("order_purchase_timestamp", TS),
        ("order_approved_at", TS),
        ("order_delivered_carrier_date", TS),
        ("order_delivered_customer_date", TS),
        ("order_estimated_delivery_date", TS),
    ),
    "products": _schema(
        ("product_id", S),
        ("product_category_name", S),
        ("product_name_lenght", I),
        ("product_description_lenght", I),
        ("product_photos_qty", I),
        ("product_weight_g", I),
        ("product_length_cm", I),
        ("product_height_cm", I),
        ("product_width_cm", I),
    ),
    "sellers": _schema(
        ("seller_id", S),
        ("seller_zip_code_prefix", S),
        ("seller_city", S),
        ("seller_state", S),
    ),
    "product_category_translation": _schema(
        ("product_category_name", S),
        ("product_category_name_english", S),
    ),
    "closed_deals": _schema(
        ("mql_id", S),
        ("seller_id", S),
        ("sdr_id", S),
        ("sr_id", S),
        ("won_date", TS),
        ("business_segment", S),
        ("lead_type", S),
        ("lead_behaviour_profile", S),
        ("has_company", B),
        ("has_gtin", B),
        ("average_stock", S),
        ("business_type", S),
        ("declared_product_catalog_size", D),
        ("declared_monthly_revenue", D),
    ),
    "marketing_qualified_leads": _schema(
        ("mql_id", S),
        ("first_contact_date", DT),
        ("landing_page_id", S),
        ("origin", S),
    ),
}

RAW_TABLES: tuple[str, ...] = tuple(sorted(RAW_SCHEMAS))

# Candidate keys tested for duplicates (geolocation has none).
KEY_FIELDS: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id",),
    "order_items": ("order_id", "order_item_id"),
    "order_payments": ("order_id", "payment_sequential"),
    "order_reviews": ("review_id",),
    "orders": ("order_id",),
    "products": ("product_id",),
    "sellers": ("seller_id",),
    "product_category_translation": ("product_category_name",),
    "closed_deals": ("mql_id",),
    "marketing_qualified_leads": ("mql_id",),
}

# The nine declared relationships whose key coverage is audited,
# as (relationship, left table, left column, right table, right column).
RELATIONSHIPS: tuple[tuple[str, str, str, str, str], ...] = (
    ("orders.customer_id -> customers.customer_id", "orders", "customer_id", "customers", "customer_id"),
    ("order_items.order_id -> orders.order_id", "order_items", "order_id", "orders", "order_id"),
    ("payments.order_id -> orders.order_id", "order_payments", "order_id", "orders", "order_id"),
    ("reviews.order_id -> orders.order_id", "order_reviews", "order_id", "orders", "order_id"),
    ("order_items.product_id -> products.product_id", "order_items", "product_id", "products", "product_id"),
    ("order_items.seller_id -> sellers.seller_id", "order_items", "seller_id", "sellers", "seller_id"),
    ("closed_deals.mql_id -> MQL.mql_id", "closed_deals", "mql_id", "marketing_qualified_leads", "mql_id"),
    ("closed_deals.seller_id -> sellers.seller_id", "closed_deals", "seller_id", "sellers", "seller_id"),
    ("closed_deals.seller_id -> order_items.seller_id", "closed_deals", "seller_id", "order_items", "seller_id"),
)
