"""Rows of crowded keys, told apart by a sketch.

A plan that moves every row once by its key is the cheapest one, but gives a key
with a large share of all rows to a single task. ``split_hot`` separates the rows
of such keys, so that they can take a plan of their own. Which keys are crowded
only decides the plan, never the result: a sketch of heavy hitters finds them in
one pass over the key column, and a hash stands for the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_HOT = 2_000  # a key with more than this share of all rows is crowded
TRACKED = 20_000  # keys that the sketch follows; its error is below half that share
LEAST_ROWS = 100_000  # rows that any task can read


def hot_keys(df: DataFrame, key: str, least: int = LEAST_ROWS) -> DataFrame:
    """(hot): hashes of the crowded keys, of which there are at most ``MOST_HOT``."""
    seen = df.select(F.xxhash64(key).alias("h")).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(h, {MOST_HOT}, {TRACKED})").alias("top")
    )
    share = F.greatest(F.col("n") / MOST_HOT, F.lit(float(least)))
    return seen.select(F.explode("top").alias("t"), share.alias("share")).where(F.col("t.count") >= F.col("share")).select(
        F.col("t.item").alias("hot")
    )


def split_hot(df: DataFrame, key: str, least: int = LEAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """(regular, crowded): the rows of ``df`` by whether their key is crowded,
    each row in one of the two. A null key is a key like any other."""
    hot = F.broadcast(hot_keys(df, key, least))  # at most MOST_HOT rows
    same = F.xxhash64(df[key]) == hot["hot"]
    return df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi")
