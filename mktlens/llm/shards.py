"""Sharding by sampled splitters.

Records are put in the order of a key (a hash of the text, then a hash of the
id), cut into ranges at quantiles of a size-weighted key sample, and the ranges
are dealt to shards so that all shards hold nearly equal bytes (law ``bytes``).

1. One narrow pass takes (id, size, key) of every record; texts go no further.
2. A key enters the sample with a probability in proportion to its size
   (a hash decides, so a retried task draws the same keys). The sample has
   about ``ranges * SAMPLES_PER_RANGE`` keys, copies of a text counting once, and
   its quantiles are splitters.
3. The bytes and rows of every range are counted exactly. In ranges overfull by
   either, the texts that alone overfill a range (a group of copies, or rows
   without text) are found and subdivided by the second key, the rest by a second
   hash of the first key. Rows of such a text that repeat the id, too, are dealt
   to parts by their stored position; as they are alike, any cut serves.
4. Units (range, hot text, part) get a start by a running sum over units; a
   record's place is the unit's start plus a running sum inside the unit. So no
   task sees more than a unit, however large one group of copies is.
5. A group of equal texts goes whole to the shard of its middle byte unless it
   weighs more than ``SPLIT_SHARE`` of a shard; then its records go one by one.

The number of ranges follows the row count (``ROWS_PER_RANGE``), hence the
splitter and unit tables, the only broadcast ones, hold a few bytes for every
``ROWS_PER_RANGE`` rows.

Defined results: null text has size 1 and the checksum of the empty text;
null ids are placed like any other; repeated rows are placed one by one; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mktlens.sources.sinks import materialize

ROWS_PER_RANGE = 4_000_000  # narrow rows, sorted by one task
MIN_RANGES = 64
SAMPLES_PER_RANGE = 64
OVERFULL = 2.0
SPLIT_SHARE = 0.01
CELLS = 4096  # key cells in which a splitter is looked up


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", number=None) -> DataFrame:
    """Narrow rows; ``number`` is a column that names each row, if there is one."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).cast("bigint").alias("text_crc32"),
        F.xxhash64(text).alias("k1"),
        F.xxhash64(F.col(id_col).cast("string"), F.lit("shard")).alias("k2"),
        (F.lit(0) if number is None else number).cast("bigint").alias("number"),
    )


def _unit_interval(h):
    """A 64-bit hash as a double in [0, 1)."""
    return F.shiftrightunsigned(h, 11).cast("double") / float(1 << 53)


def _cell(k1):
    """Order-keeping cell of a signed 64-bit key."""
    return (F.shiftright(k1, 52) + CELLS // 2).cast("int")


def splitters(rows: DataFrame, total: int, ranges: int) -> DataFrame:
    """(cell, before, bounds): for each key cell the splitters inside it and
    how many lie below it. ``CELLS`` rows, ``ranges - 1`` splitters in all."""
    rate = ranges * SAMPLES_PER_RANGE / max(total, 1)
    sample = rows.where(
        _unit_interval(F.xxhash64("k1", "k2", F.lit("sample"))) < F.col("size") * F.lit(rate)
    )
    # A text counts once, however many copies were drawn: hot texts are subdivided
    # later, and so few keys have exact quantiles, whatever their order.
    sample = sample.select("k1").distinct()
    shares = ", ".join(f"{i / ranges!r}D" for i in range(1, ranges))
    quantiles = F.expr(f"percentile_approx(k1, array({shares}), {100 * ranges})")
    bounds = sample.agg(quantiles.alias("b")).select(F.posexplode("b").alias("i", "bound"))
    per_cell = bounds.groupBy(_cell(F.col("bound")).alias("cell")).agg(
        F.sort_array(F.collect_list("bound")).alias("bounds"), F.count("*").alias("n")
    )
    w = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.sparkSession.range(CELLS).select(F.col("id").cast("int").alias("cell"))
    return cells.join(F.broadcast(per_cell), "cell", "left").select(
        "cell",
        F.coalesce(F.sum(F.coalesce("n", F.lit(0))).over(w), F.lit(0)).cast("int").alias("before"),
        F.coalesce("bounds", F.array().cast("array<bigint>")).alias("bounds"),
    )


def shard(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, range_id) of every record."""
    return _placed(keyed(docs, id_col, text_col), n_shards).drop("number")


def _placed(rows: DataFrame, n_shards: int) -> DataFrame:
    rows = materialize(rows, "shard-keys")
    seen = rows.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    n, total = seen["n"], seen["bytes"] or 0
    ranges = max(MIN_RANGES, math.ceil(n / ROWS_PER_RANGE))
    target = max(total / ranges, 1.0)
    row_target = max(n / ranges, 1.0)

    cells = F.broadcast(splitters(rows, total, ranges))
    ranged = rows.withColumns({"cell": _cell(F.col("k1")), "position": F.monotonically_increasing_id()})
    ranged = ranged.join(cells, "cell").select(
        *rows.columns,
        "position",
        (F.col("before") + F.size(F.filter("bounds", lambda b: b < F.col("k1")))).alias("range_id"),
    )
    weight = lambda out: (F.sum("size").alias(f"{out}_bytes"), F.count("*").alias(f"{out}_rows"))
    over = lambda of, times: (F.col(f"{of}_bytes") > times * target) | (F.col(f"{of}_rows") > times * row_target)
    full = ranged.groupBy("range_id").agg(*weight("range")).where(over("range", OVERFULL))
    # Texts that alone overfill a range, and rows alike within them: at most as
    # many of either as there are ranges, by bytes and by rows.
    crowded = ranged.join(F.broadcast(full), "range_id")
    hot = crowded.groupBy("k1").agg(*weight("hot")).where(over("hot", 1.0))
    alike = crowded.groupBy("k1", "k2").agg(*weight("alike")).where(over("alike", 1.0))
    parts = lambda of: F.ceil(
        F.greatest(F.col(f"{of}_bytes") / target, F.col(f"{of}_rows") / row_target)
    ).cast("int")
    is_hot, is_alike = F.col("hot_rows").isNotNull(), F.col("alike_rows").isNotNull()
    dealt = lambda h, of: F.floor(_unit_interval(h) * parts(of)).cast("int")
    units = (
        ranged.join(F.broadcast(full), "range_id", "left")
        .join(F.broadcast(hot), "k1", "left")
        .join(F.broadcast(alike), ["k1", "k2"], "left")
        .withColumn("hot_key", F.when(is_hot, F.col("k1")))
        .withColumn("alike_key", F.when(is_alike, F.col("k2")))
        .withColumn(
            "part",
            F.when(is_alike, dealt(F.xxhash64("position"), "alike"))
            .when(is_hot, dealt(F.col("k2"), "hot"))
            .when(F.col("range_rows").isNotNull(), dealt(F.xxhash64("k1", F.lit("part")), "range"))
            .otherwise(F.lit(0)),
        )
        .select(*rows.columns, "range_id", "hot_key", "alike_key", "hot_bytes", "part")
        .withColumn(
            "unit",
            F.xxhash64(
                "range_id", F.coalesce("hot_key", F.lit(0)), "hot_key", F.coalesce("alike_key", F.lit(0)), "alike_key", "part"
            ),
        )
    )
    units = materialize(units, "shard-units")

    order = Window.orderBy(
        "range_id", F.col("hot_key").asc_nulls_first(), F.col("alike_key").asc_nulls_first(), "part"
    ).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        units.groupBy("unit", "range_id", "hot_key", "alike_key", "part")
        .agg(F.sum("size").alias("b"))
        .withColumn("start_bytes", F.coalesce(F.sum("b").over(order), F.lit(0)))
        # The first byte of a hot text, which has several units.
        .withColumn("hot_start", F.min("start_bytes").over(Window.partitionBy("range_id", "hot_key")))
        .select("unit", "start_bytes", "hot_start")
    )
    sorting = ("k1", "k2", "doc_id", "size", "text_crc32", "number")
    inside = Window.partitionBy("unit").orderBy(*sorting)
    run = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    group = Window.partitionBy("unit", "k1")
    per_shard = max(total / n_shards, 1.0)
    placed = (
        units.withColumn("upto", F.sum("size").over(run))
        .withColumn("group_bytes", F.coalesce("hot_bytes", F.sum("size").over(group)))
        .withColumn("group_upto", F.max("upto").over(group))
        .join(F.broadcast(starts), "unit")
        .withColumn(
            "group_middle",
            F.when(F.col("hot_key").isNotNull(), F.col("hot_start") + F.col("group_bytes") / 2).otherwise(
                F.col("start_bytes") + F.col("group_upto") - F.col("group_bytes") / 2
            ),
        )
        .withColumn(
            "middle",
            F.when(F.col("group_bytes") <= SPLIT_SHARE * per_shard, F.col("group_middle")).otherwise(
                F.col("start_bytes") + F.col("upto") - F.col("size") / 2
            ),
        )
        .withColumn("shard", F.least(F.floor(F.col("middle") / per_shard), F.lit(n_shards - 1)).cast("int"))
        .select(*rows.columns, "range_id", "unit", "start_bytes", "shard")
    )
    placed = materialize(placed, "shard-placed")

    before = Window.partitionBy("shard").orderBy("start_bytes", "unit").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "start_bytes", "unit")
        .agg(F.count("*").alias("c"))
        .select("shard", "unit", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("slot_before"))
    )
    numbered = Window.partitionBy("unit", "shard").orderBy(*sorting)
    return (
        placed.withColumn("rn", F.row_number().over(numbered))
        .join(F.broadcast(offsets), ["shard", "unit"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "shard",
            (F.col("slot_before") + F.col("rn") - 1).cast("bigint").alias("slot"),
            "range_id",
            "number",
        )
    )


def write_shards(docs: DataFrame, path: str, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the records as ``path/shard=<n>`` folders; returns the plan.

    Rows are numbered in a copy below the shared folder, and row and plan meet by
    that number, so every row is written once and where the plan puts it, however
    often its id and text repeat. An input column of the name ``shard`` is kept:
    underscores are then added to the name of the folders' column."""
    taken = {c.lower() for c in docs.columns}
    folder, row = "shard", "_shard_row"
    while folder in taken:
        folder += "_"
    while row in taken:
        row += "_"
    copy = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "shard-rows")
    plan = materialize(_placed(keyed(copy, id_col, text_col, F.col(row)), n_shards), "shard-plan")
    place = plan.select(F.col("number").alias(row), F.col("shard").alias(folder))
    copy.join(place, row).drop(row).write.mode("errorifexists").partitionBy(folder).parquet(path)
    return plan.drop("number")
