"""Metric tables built from scalar aggregates.

A reconciliation compares one aggregate of a source layer with one of a
model layer. Each aggregate is an uncorrelated scalar subquery; Spark merges
scalar subqueries over the same plan into one aggregate and runs independent
ones concurrently, and the final rows are produced from a single row with
``inline`` (no driver round trip, no fixed input table).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalar(df: DataFrame, agg: Column) -> Column:
    """``(SELECT agg FROM df)`` as a column."""
    return df.select(agg).scalar()


def comparison_table(
    anchor: DataFrame,
    metrics: Sequence[tuple[str, Column, Column]],
    value_type: str,
    model_label: str = "model_value",
) -> DataFrame:
    """Rows (metric_name, source_value, <model_label>, difference, check_status).

    ``anchor`` is any DataFrame; it is reduced to one row so the metric
    columns can be evaluated. NULL on either side yields FAIL, since NULL is
    never equal to anything.
    """
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("metric_name"),
                src.cast(value_type).alias("source_value"),
                mdl.cast(value_type).alias(model_label),
            )
            for name, src, mdl in metrics
        ]
    )
    one = anchor.agg(F.count("*").alias("_anchor_rows"))
    t = one.select(F.inline(rows))
    src, mdl = F.col("source_value"), F.col(model_label)
    return t.select(
        "metric_name",
        "source_value",
        model_label,
        (mdl - src).cast(value_type).alias("difference"),
        F.when(mdl == src, "PASS").otherwise("FAIL").alias("check_status"),
    )


def check_summary(checks: DataFrame) -> DataFrame:
    """Total, passed and failed checks of a comparison table."""
    status = F.col("check_status")
    return checks.agg(
        F.count("*").cast("bigint").alias("total_checks"),
        F.count_if(status == "PASS").cast("bigint").alias("passed_checks"),
        F.count_if(status == "FAIL").cast("bigint").alias("failed_checks"),
    )
