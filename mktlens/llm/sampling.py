"""Bounded samples of labelled documents for fitting a classifier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def least_hashes(df: DataFrame, key: Column, n: int, most: int) -> DataFrame:
    """The ``most`` rows of ``df`` (of ``n``) with the least hashes of ``key``.

    Rows above the hash that nearly ``most`` rows are expected to stay below
    are dropped where they are read, so that a sort sees a few more than
    ``most`` rows, however many there are."""
    unit = F.shiftrightunsigned(F.xxhash64(key), 11) / F.lit(float(1 << 53))
    share = (most + 6 * most**0.5 + 20) / max(n, 1)
    near = df.withColumn("_unit", unit).where(F.col("_unit") < share)
    return near.orderBy("_unit", *df.columns).limit(most).drop("_unit")


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    grade: Column,
    per_grade: Sequence[int],
    max_bytes: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[list[tuple[str, int]], list[int]]:
    """At most ``per_grade[g]`` (text, g) pairs of each grade g, and how many
    labelled ids each grade has in all.

    ``grade`` is a column over ``labels`` (null: not to be learnt from). The
    sample is the ids with the least hashes, so it does not depend on file
    order. Texts over ``max_bytes`` are not used for fitting. A label id that
    is null or not in ``docs`` is not used; repeated labels of an id count by
    their least grade. The driver receives at most
    ``sum(per_grade) * max_bytes`` bytes.
    """
    graded = (
        labels.select(F.col(id_col).alias("_id"), grade.alias("_grade"))
        .where(F.col("_id").isNotNull() & F.col("_grade").isNotNull())
        .groupBy("_id")
        .agg(F.min("_grade").alias("_grade"))
    )
    counts = {r["_grade"]: r["n"] for r in graded.groupBy("_grade").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for g, most in enumerate(per_grade):
        part = least_hashes(graded.where(F.col("_grade") == g), F.col("_id").cast("string"), counts.get(g, 0), most)
        chosen = part if chosen is None else chosen.unionAll(part)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(
        F.octet_length("_text") <= max_bytes
    )
    # Ids repeated in docs: one text each, so the sample stays within its bound.
    found = texts.join(F.broadcast(chosen), "_id").groupBy("_id").agg(F.min("_text").alias("t"), F.min("_grade").alias("g"))
    rows = found.collect()
    rows.sort(key=lambda r: r["_id"])
    return [(r["t"], int(r["g"])) for r in rows], [counts.get(g, 0) for g in range(len(per_grade))]
