"""Connected components of a link table, in Spark.

Alternating large-star and small-star steps: every vertex tells its larger
neighbours its smallest one, then every vertex tells its smaller neighbours.
The links shrink to stars around each component's smallest vertex in a number
of rounds that grows with the logarithm of the longest chain. Each round is
written to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktlens.sources.sinks import materialize


def _round(e: DataFrame) -> DataFrame:
    near = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(e.select("lo", "hi"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = (
        near.where(F.col("v") > F.col("u"))
        .join(least, "u")
        .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        .distinct()
    )
    root = large.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = large.join(root, "hi").where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionAll(root.select("hi", F.col("m").alias("lo"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(vertex, root) for every vertex of a link between two different
    vertices; root is the smallest vertex of its component. No links, no rows;
    repeated links and self-links are allowed, nulls are left out."""
    e = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    before = None
    while True:
        e = materialize(e, "components")
        seen = e.agg(
            F.count("*").alias("n"),
            F.countDistinct("hi").alias("vertices"),
            F.bit_xor(F.xxhash64("hi", "lo")).alias("sign"),
        ).first()
        if seen["n"] == 0 or tuple(seen) == before:
            break
        before = tuple(seen)
        e = _round(e)
    return e.select(F.col("hi").alias("vertex"), F.col("lo").alias("root")).unionAll(e.select("lo", "lo").distinct())
