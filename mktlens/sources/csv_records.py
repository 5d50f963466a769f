"""Records of CSV files, cut in parallel.

A quoted field may hold line breaks, so a line of a file is not always a record,
and whether a line lies inside a field depends on every quote before it. Files
are read as lines in splits; each split sends the parity of its quotes, and the
parities of a file's earlier splits, summed, tell whether a split starts inside
a field. Then a split's lines are put together to records by themselves. What
a split border cuts is put together from its pieces, of which a split has two at
most. A doubled quote inside a field counts twice and changes nothing.

No task reads a file as a whole; rows travel once, by split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BOM = "﻿"


def csv_records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """(file, is_first, record): every record of the files at ``path``; the first
    one of a file (its header) is marked. Line breaks inside a record stay as
    they are; empty lines are no records, and a byte order mark is dropped."""
    place = F.col("_metadata")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        place["file_path"].alias("file"),
        place["file_block_start"].alias("split"),
        F.monotonically_increasing_id().alias("pos"),  # grows along a split
        "value",
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    lines = lines.withColumn("odd", quotes % 2)
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        lines.groupBy("file", "split")
        .agg(F.sum("odd").alias("quotes"))
        .select("file", "split", (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2).alias("inside"))
    )
    along = Window.partitionBy("file", "split").orderBy("pos")
    before = F.col("inside") + F.coalesce(F.sum("odd").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = lines.join(splits, ["file", "split"]).withColumn("starts", (before % 2 == 0).cast("int"))
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda x: x["value"]), "\n")
    parts = (
        numbered.withColumn("record", F.sum("starts").over(upto))
        .groupBy("file", "split", "record")
        .agg(joined(F.struct("pos", "value")).alias("value"), (F.sum("odd") % 2 == 1).alias("odd"))
        # record 0 goes on with what an earlier split began; one with an open quote goes on in a later one
        .withColumn("tail", (F.col("record") > 0) & F.col("odd"))
    )
    cut = (F.col("record") == 0) | F.col("tail")
    first = (F.col("split") == 0) & (F.col("record") == 1)
    order = Window.partitionBy("file").orderBy("split", "tail").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mended = (
        parts.where(cut)
        .withColumn("begun", F.sum(F.col("tail").cast("int")).over(order))
        .groupBy("file", "begun")
        .agg(F.max(first).alias("is_first"), joined(F.struct("split", "tail", "value")).alias("record"))
    )
    whole = parts.where(~cut).select("file", first.alias("is_first"), F.col("value").alias("record"))
    records = whole.unionByName(mended.drop("begun")).withColumn("record", F.regexp_replace("record", "\r$", ""))
    unmarked = F.when(F.col("is_first") & F.startswith("record", F.lit(BOM)), F.substring("record", F.lit(2), F.length("record")))
    return records.withColumn("record", F.coalesce(unmarked, "record")).where(F.col("record") != "")
