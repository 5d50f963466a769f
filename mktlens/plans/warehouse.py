"""The view graph: raw -> staging -> marts -> analyses -> quality.

``Warehouse`` builds each view once, lazily, as a DataFrame. Nothing runs
until an action; a view used by several consumers is the *same* logical plan
object, so inside one query Spark reuses its exchanges, and across queries a
caller may ``persist()`` or ``materialize()`` it (see ``materialized``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from mktlens.plans import analysis, marts, quality, staging
from mktlens.sources import RawTables, load_raw, materialize, register


class Warehouse:
    def __init__(self, raw: RawTables):
        self.raw = raw
        self.spark: SparkSession = raw.spark

    @classmethod
    def at(cls, spark: SparkSession, sf_dir: str) -> "Warehouse":
        return cls(load_raw(spark, sf_dir))

    # ---------------------------------------------------------- staging
    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw["orders"])

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw["order_items"])

    @cached_property
    def stg_order_payments(self) -> DataFrame:
        return staging.stg_order_payments(self.raw["order_payments"])

    @cached_property
    def stg_marketing_funnel(self) -> DataFrame:
        return staging.stg_marketing_funnel(self.raw["marketing_qualified_leads"], self.raw["closed_deals"])

    # ---------------------------------------------------------- marts
    @cached_property
    def mart_orders(self) -> DataFrame:
        return marts.mart_orders(
            self.stg_orders, self.stg_order_items, self.stg_order_payments, self.raw["customers"]
        )

    @cached_property
    def mart_order_seller(self) -> DataFrame:
        return marts.mart_order_seller(
            self.stg_order_items,
            self.raw["products"],
            self.raw["product_category_translation"],
            self.stg_orders,
            self.raw["sellers"],
            self.raw["order_reviews"],
        )

    @cached_property
    def order_seller_facts(self) -> DataFrame:
        """``mart_order_seller`` without dimensions; not published."""
        return marts.order_seller_facts(self.stg_order_items, self.stg_orders, self.raw["order_reviews"])

    @cached_property
    def mart_marketing_funnel(self) -> DataFrame:
        return marts.mart_marketing_funnel(self.stg_marketing_funnel)

    @cached_property
    def mart_seller_lifecycle(self) -> DataFrame:
        return marts.mart_seller_lifecycle(self.stg_marketing_funnel, self.order_seller_facts)

    # ---------------------------------------------------------- analyses
    @cached_property
    def acquisition_channel_quality(self) -> DataFrame:
        return analysis.acquisition_channel_quality(self.mart_marketing_funnel, self.mart_seller_lifecycle)

    @cached_property
    def seller_activation_performance(self) -> DataFrame:
        return analysis.seller_activation_performance(self.mart_seller_lifecycle)

    @cached_property
    def delivery_review_analysis(self) -> DataFrame:
        return analysis.delivery_review_analysis(self.mart_orders, self.raw["order_reviews"])

    # ---------------------------------------------------------- quality
    @cached_property
    def join_fanout_reconciliation(self) -> DataFrame:
        return quality.join_fanout_reconciliation(
            self.stg_orders, self.stg_order_items, self.stg_order_payments, self.mart_orders, self.mart_order_seller
        )

    @cached_property
    def final_kpi_validation(self) -> DataFrame:
        r = self.raw
        return quality.final_kpi_validation(
            r["orders"],
            r["marketing_qualified_leads"],
            r["closed_deals"],
            r["sellers"],
            r["order_reviews"],
            self.mart_orders,
            self.mart_order_seller,
            self.mart_marketing_funnel,
            self.mart_seller_lifecycle,
            self.acquisition_channel_quality,
            self.delivery_review_analysis,
        )

    # ---------------------------------------------------------- publishing
    LAYERS = {
        "staging": ("stg_orders", "stg_order_items", "stg_order_payments", "stg_marketing_funnel"),
        "marts": ("mart_orders", "mart_order_seller", "mart_marketing_funnel", "mart_seller_lifecycle"),
        "analysis": ("acquisition_channel_quality", "seller_activation_performance", "delivery_review_analysis"),
        "quality": ("join_fanout_reconciliation", "final_kpi_validation"),
    }

    def publish(self, prefix: str = "") -> list[str]:
        """Register every view as a temporary view named ``<prefix><view>``
        (``CREATE OR REPLACE VIEW``); nothing is computed. Returns the names."""
        names = []
        for views in self.LAYERS.values():
            for v in views:
                register(self.spark, prefix + v, getattr(self, v))
                names.append(prefix + v)
        return names

    # ---------------------------------------------------------- persistence
    def materialized(self, names: tuple[str, ...] = ("stg_marketing_funnel", "mart_order_seller", "mart_orders")) -> "Warehouse":
        """Write the named shared views to the cluster's shared folder once and
        serve downstream views from those files (durable across executor
        loss; lineage is cut at the written table)."""
        for name in names:
            df = getattr(self, name)
            self.__dict__[name] = materialize(df, name)
        return self
