"""Key-quality operators: grain, duplicate keys, join coverage.

All are distributed aggregations: key sets are never collected, and every
distinct count is planned by Spark as a partial aggregate first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mktlens.functions import rounded_quotient


def grain_violations(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Keys that occur more than once: (grain..., row_count)."""
    return (
        df.groupBy(*grain)
        .agg(F.count("*").cast("bigint").alias("row_count"))
        .where(F.col("row_count") > 1)
    )


def duplicate_key_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows minus distinct keys (surplus rows). NULL key parts group together,
    as an absent CSV field is one blank value."""
    per_key = df.groupBy(*key).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_key_rows"))


def tracked_keys(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-blank values of a key column."""
    c = F.col(column)
    return df.where(c.isNotNull() & (c.cast("string") != "")).select(c.cast("string").alias("key")).distinct()


def join_coverage(left: DataFrame, lcol: str, right: DataFrame, rcol: str) -> DataFrame:
    """Distinct left keys, how many exist on the right, unmatched, match rate.

    Both key sets are distinct before the join, so the join cannot fan out;
    the right keys are a left-outer lookup on a hash-partitioned key set.
    """
    lk = tracked_keys(left, lcol)
    rk = tracked_keys(right, rcol).withColumn("hit", F.lit(True))
    j = lk.join(rk, "key", "left")
    total = F.count("*")
    matched = F.count_if(F.col("hit"))
    return j.agg(
        total.cast("bigint").alias("distinct_left_keys"),
        matched.cast("bigint").alias("matched_left_keys"),
        (total - matched).cast("bigint").alias("unmatched_left_keys"),
        rounded_quotient(matched, total, 6).alias("match_rate"),
    )


def _domains(relationships: Sequence[tuple[str, str, str, str, str]]) -> dict[tuple[str, str], tuple[int, int]]:
    """(table, column) -> (key domain, bit): columns that a relationship joins,
    directly or through others, share a domain, and each has a bit of its own."""
    group: dict[tuple[str, str], set[tuple[str, str]]] = {}
    for _, lt, lc, rt, rc in relationships:
        both = group.setdefault((lt, lc), {(lt, lc)}) | group.setdefault((rt, rc), {(rt, rc)})
        for member in both:
            group[member] = both
    out: dict[tuple[str, str], tuple[int, int]] = {}
    for d, members in enumerate(sorted({tuple(sorted(g)) for g in group.values()})):
        for i, member in enumerate(members):
            out[member] = (d, 1 << i)
    return out


def coverages(tables: Mapping[str, DataFrame], relationships: Sequence[tuple[str, str, str, str, str]]) -> DataFrame:
    """``join_coverage`` of every relationship (name, left table and column, right
    table and column) from one key exchange: (relationship, left_key, right_key,
    distinct_left_keys, matched_left_keys, unmatched_left_keys, match_rate).

    Each column is read once, whatever the number of its relationships. A key
    travels with the bit of its column, combined by OR where it is read, so a key
    that a third of all rows share is one row of a task; all counts are then read
    from the masks, of which there are a handful of different ones.
    """
    place = _domains(relationships)
    keys = None
    for (table, column), (domain, bit) in place.items():
        c = F.col(column).cast("string")
        part = tables[table].where(c.isNotNull() & (c != "")).select(
            F.lit(domain).alias("domain"), c.alias("key"), F.lit(bit).cast("bigint").alias("bit")
        )
        keys = part if keys is None else keys.unionByName(part)
    masks = (
        keys.groupBy("domain", "key")
        .agg(F.bit_or("bit").alias("mask"))
        .groupBy("domain", "mask")
        .agg(F.count("*").alias("n"))
    )

    def keys_in(domain: int, bits: int) -> Column:
        there = (F.col("domain") == domain) & (F.col("mask").bitwiseAND(bits) == bits)
        return F.coalesce(F.sum(F.when(there, F.col("n"))), F.lit(0)).cast("bigint")

    counts = []
    for name, lt, lc, rt, rc in relationships:
        domain, left = place[lt, lc]
        _, right = place[rt, rc]
        counts.append(
            F.struct(
                F.lit(name).alias("relationship"),
                F.lit(f"{lt}.{lc}").alias("left_key"),
                F.lit(f"{rt}.{rc}").alias("right_key"),
                keys_in(domain, left).alias("distinct_left_keys"),
                keys_in(domain, left | right).alias("matched_left_keys"),
            )
        )
    total, matched = F.col("distinct_left_keys"), F.col("matched_left_keys")
    return masks.agg(F.array(*counts).alias("rows")).select(F.inline("rows")).select(
        "*", (total - matched).alias("unmatched_left_keys"), rounded_quotient(matched, total, 6).alias("match_rate")
    )
