"""Source profiling: key quality, missing values, schema drift, join
coverage and seller-activation feasibility, all as distributed jobs.

Only the final report rows (one per table, column or relationship) are
small; every key set, counter and date list of a single-machine profiler
is replaced by a grouped aggregation or a semi/anti join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mktlens.functions import count_where, day_of, days_between, rounded_quotient
from mktlens.operators import coverages, duplicate_key_rows, totals_from
from mktlens.sources.raw import RawTables
from mktlens.sources.schemas import KEY_FIELDS, RAW_SCHEMAS, RELATIONSHIPS

# ------------------------------------------------------------ C1 - C6


def orders_grain(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.count("*").cast("bigint").alias("total_rows"),
        F.count_distinct("order_id").cast("bigint").alias("unique_order_ids"),
    )


def orders_missing_fields(orders: DataFrame) -> DataFrame:
    return orders.agg(
        count_where(F.col("order_id").isNull()).alias("missing_order_id"),
        count_where(F.col("customer_id").isNull()).alias("missing_customer_id"),
        count_where(F.col("order_purchase_timestamp").isNull()).alias("missing_purchase_timestamp"),
    )


def duplicate_order_items(items: DataFrame) -> DataFrame:
    return (
        items.groupBy("order_id", "order_item_id")
        .agg(F.count("*").cast("bigint").alias("row_count"))
        .where(F.col("row_count") > 1)
    )


def _repeated(reviews: DataFrame, key: str) -> DataFrame:
    return reviews.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def duplicated_review_ids(reviews: DataFrame) -> DataFrame:
    return _repeated(reviews, "review_id").agg(F.count("*").cast("bigint").alias("duplicated_review_ids"))


def duplicate_review_detail(reviews: DataFrame, top: int = 20) -> DataFrame:
    """Top repeated review ids by row count (a top-k report: the limit is the
    feature). Ties on row count are broken by review_id for a stable answer.
    Spark plans ``orderBy().limit()`` as a per-partition top-k plus a final
    merge of at most ``top`` rows per partition."""
    return (
        reviews.groupBy("review_id")
        .agg(
            F.count("*").cast("bigint").alias("row_count"),
            F.count_distinct("order_id").cast("bigint").alias("order_count"),
            F.count_distinct("review_score").cast("bigint").alias("score_count"),
        )
        .where(F.col("row_count") > 1)
        .orderBy(F.col("row_count").desc(), F.col("review_id").asc())
        .limit(top)
    )


def orders_with_multiple_reviews(reviews: DataFrame) -> DataFrame:
    return _repeated(reviews, "order_id").agg(F.count("*").cast("bigint").alias("orders_with_multiple_reviews"))


# ------------------------------------------------------------ T1 - T7


def _missing(c: str, dtype: T.DataType) -> F.Column:
    """A value is missing when NULL; for text also when empty."""
    col = F.col("`" + c.replace("`", "``") + "`")
    if isinstance(dtype, T.StringType):
        return col.isNull() | (col == "")
    return col.isNull()


def null_counts(df: DataFrame, table: str) -> DataFrame:
    """Long form (table_name, column_name, column_position, missing_count):
    one aggregation pass computes every column, ``inline`` unpivots it."""
    fields = df.schema.fields
    counts = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(i).cast("bigint").alias("column_position"),
            count_where(_missing(f.name, f.dataType)).alias("missing_count"),
        )
        for i, f in enumerate(fields, 1)
    ]
    return df.agg(F.array(*counts).alias("rows")).select(F.inline("rows")).select(
        F.lit(table).alias("table_name"), "column_name", "column_position", "missing_count"
    )


def schema_drift(df: DataFrame, expected: T.StructType | Sequence[str]) -> tuple[list[str], list[str]]:
    """(missing expected columns, unexpected columns), in contract/file order.
    A schema is metadata, so this is a driver-side comparison of names."""
    exp = [f.name for f in expected.fields] if isinstance(expected, T.StructType) else list(expected)
    cols = df.columns
    return [c for c in exp if c not in cols], [c for c in cols if c not in exp]


def drift_columns(found: DataFrame, expected: T.StructType) -> list[F.Column]:
    """Column count, missing and unexpected columns and status of a source as
    it arrives, as literal columns."""
    missing, unexpected = schema_drift(found, expected)
    return [
        F.lit(len(found.columns)).cast("bigint").alias("column_count"),
        F.lit(", ".join(missing)).alias("missing_expected_columns"),
        F.lit(", ".join(unexpected)).alias("unexpected_columns"),
        F.lit("PASS" if not missing and not unexpected else "REVIEW").alias("schema_status"),
    ]


def drift_report(tables: RawTables) -> DataFrame:
    """One row per raw table with a source: rows and columns of the source as
    it arrives, before any conforming, against the contract."""
    parts = []
    for t in sorted(tables):
        found = tables.as_found(t)
        parts.append(
            found.agg(F.count("*").cast("bigint").alias("rows")).select(
                F.lit(t).alias("table_name"), "rows", *drift_columns(found, RAW_SCHEMAS[t])
            )
        )
    return _union(parts)


def profile_table(df: DataFrame, table: str, expected: T.StructType | None = None, found: DataFrame | None = None) -> DataFrame:
    """One row: rows, columns, candidate key, surplus key rows, drift, status.
    ``found`` is the table before conforming (``df`` itself by default)."""
    columns, missing, unexpected, status = drift_columns(df if found is None else found, expected or RAW_SCHEMAS[table])
    key = KEY_FIELDS.get(table)
    rows = df.agg(F.count("*").cast("bigint").alias("rows"))
    if key:
        dup = duplicate_key_rows(df, key).select("duplicate_key_rows").scalar()
    else:
        dup = F.lit(None).cast("bigint")
    return rows.select(
        F.lit(table).alias("table_name"),
        "rows",
        columns,
        F.lit(", ".join(key) if key else None).cast("string").alias("candidate_key"),
        dup.alias("duplicate_candidate_key_rows"),
        missing,
        unexpected,
        status,
    )


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def raw_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``profile_table`` for every raw table present, one row each. Drift is
    that of the table's own file, where there is one."""
    own = getattr(tables, "native", False)
    return _union([profile_table(tables[t], t, found=tables.as_found(t) if own else None) for t in sorted(tables)])


def raw_null_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union([null_counts(tables[t], t) for t in sorted(tables)])


def coverage_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Key coverage of the nine declared relationships, from one exchange of
    keys; a table that is not there is an error (``KeyError``), never a
    relationship left out."""
    return coverages(tables, RELATIONSHIPS)


def profile_report(tables: RawTables, sizes: DataFrame | None = None) -> dict[str, DataFrame]:
    """All parts of the source report: ``files`` (one row per table, with
    ``sizes`` the bytes as well), ``null_counts``, ``join_coverage``, and the
    activation feasibility in total and by origin. Nothing runs yet."""
    leads, deals = tables["marketing_qualified_leads"], tables["closed_deals"]
    items, orders = tables["order_items"], tables["orders"]
    files = raw_profile(tables)
    if sizes is not None:
        files = files.join(sizes.select("table_name", "size_bytes"), "table_name", "left")
    return {
        "files": files,
        "null_counts": raw_null_counts(tables),
        "join_coverage": coverage_report(tables),
        "activation": activation_summary(leads, deals, items, orders),
        "activation_by_origin": activation_by_origin(leads, deals, items, orders),
    }


# ------------------------------------------------------------ F1 - F2


def _profiler_origin(origin: F.Column) -> F.Column:
    """Lead origin as the profiler reads it: blank -> 'unknown', no trimming."""
    return F.when(origin.isNull() | (origin == ""), F.lit("unknown")).otherwise(origin)


def seller_order_days(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Distinct (seller_id, order_day) for sellers' orders that have a date.

    Items meet their order first; what a task has met of a seller and day is one
    row before it travels. A seller with a third of all orders contributes a
    bounded row set to any join with deals.
    """
    so = items.select("seller_id", "order_id").where(F.col("seller_id").isNotNull())
    od = orders.select("order_id", day_of("order_purchase_timestamp").alias("order_day")).where(
        F.col("order_day").isNotNull()
    )
    return so.join(od, "order_id").select("seller_id", "order_day").distinct()


def deal_activity(leads: DataFrame, deals: DataFrame, items: DataFrame, orders: DataFrame) -> DataFrame:
    """Per distinct closed deal (lead, seller, win day) with its number of
    rows ``m``: origin, any order, any pre-win order, first post-win day.

    Every deal row counts, also one without a seller (it has no orders) or
    without a win date (it may have orders, but none before or after the win;
    the single-machine profiler stops at such a row). A lead listed twice does
    not multiply its deals: it lends them its greatest origin, since a table
    has no last row.
    """
    origins = leads.groupBy("mql_id").agg(F.max(_profiler_origin(F.col("origin"))).alias("origin"))
    d = (
        deals.groupBy("mql_id", "seller_id", day_of("won_date").alias("won_day"))
        .agg(F.count("*").alias("m"))
        .join(origins, "mql_id", "left")
        .select("mql_id", "seller_id", "won_day", "m", F.coalesce("origin", F.lit("unknown")).alias("origin"))
    )
    after = totals_from(d, seller_order_days(items, orders), "seller_id", "won_day", "order_day", [])
    return after.select(
        *d.columns,
        F.col("least_day").isNotNull().alias("has_order"),
        F.coalesce(F.col("least_day") < F.col("won_day"), F.lit(False)).alias("has_pre_win_order"),
        F.col("first_day").alias("first_post_win_day"),
        days_between("first_day", "won_day").alias("days_to_first_post_win_sale"),
    )


def _rows_where(pred: F.Column) -> F.Column:
    """Deal rows of the distinct deals that satisfy ``pred``."""
    return F.coalesce(F.sum(F.when(pred, F.col("m"))), F.lit(0)).cast("bigint")


def activation_summary(leads: DataFrame, deals: DataFrame, items: DataFrame, orders: DataFrame) -> DataFrame:
    """Closed deals, with any order, activated after the win, with a pre-win
    order, and exact median/min/max days from win to first post-win sale
    (a deal listed m times weighs m times)."""
    delay = F.col("days_to_first_post_win_sale")
    return deal_activity(leads, deals, items, orders).agg(
        _rows_where(F.lit(True)).alias("closed_deals"),
        _rows_where(F.col("has_order")).alias("closed_sellers_with_any_order"),
        _rows_where(delay.isNotNull()).alias("post_win_activated_sellers"),
        _rows_where(F.col("has_pre_win_order")).alias("sellers_with_pre_win_orders"),
        F.percentile(delay, 0.5, F.col("m")).cast("double").alias("median_days_to_first_post_win_sale"),
        F.min(delay).alias("minimum_days_to_first_post_win_sale"),
        F.max(delay).alias("maximum_days_to_first_post_win_sale"),
    )


def activation_by_origin(leads: DataFrame, deals: DataFrame, items: DataFrame, orders: DataFrame) -> DataFrame:
    """Per lead origin: leads, deals, deals with any order, activated, rates."""
    mqls = leads.groupBy(_profiler_origin(F.col("origin")).alias("origin")).agg(
        F.count("*").cast("bigint").alias("mqls")
    )
    per = deal_activity(leads, deals, items, orders).groupBy("origin").agg(
        _rows_where(F.lit(True)).alias("closed"),
        _rows_where(F.col("has_order")).alias("ordered"),
        _rows_where(F.col("first_post_win_day").isNotNull()).alias("activated"),
    )
    filled = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("closed", "ordered", "activated")}
    j = mqls.join(per, "origin", "left").withColumns(filled)
    return j.select(
        "origin",
        "mqls",
        F.col("closed").alias("closed_deals"),
        F.col("ordered").alias("closed_sellers_with_any_order"),
        F.col("activated").alias("post_win_activated_sellers"),
        rounded_quotient("closed", "mqls", 6).alias("mql_to_close_rate"),
        rounded_quotient("activated", "closed", 6).alias("closed_to_activation_rate"),
    ).orderBy("origin")


def closed_seller_orders(deals: DataFrame, items: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders (id, purchase day) of sellers that closed a deal: two semi
    joins, the first on the distinct closed-seller set."""
    sellers = deals.select("seller_id").where(F.col("seller_id").isNotNull()).distinct()
    rel = items.join(sellers, "seller_id", "left_semi").select("order_id").distinct()
    return orders.join(rel, "order_id", "left_semi").select(
        "order_id", day_of("order_purchase_timestamp").alias("order_day")
    )
