"""Benchmark decontamination with a broadcast hash set of test n-grams.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased (A-Z) text.
A window is ``WINDOW`` consecutive words of a benchmark item; an item of fewer
words is one window. The hashes of all windows are broadcast as a hash set;
every document forms the hashes of all its own windows (pair by pair, four
steps for ten words), and each probes the set in the task that reads the
document. Only the windows found travel, with their words, and are verified word
for word against the benchmark's. Verified hits are narrow rows that meet per
document.

A broadcast set holds at most ``SET_BYTES`` (counted before, ``HASH_BYTES`` a
hash: six million windows). A larger set is cut into slices, which are broadcast
one after the other against the hashes of the documents, written once. So the
windows of the corpus are never exchanged. The windows' words are broadcast when
they measure at most ``BROADCAST_BYTES``, else they meet the windows found in a
shuffled join. The results are the same.

Defined results: null or blank texts have no words and no hits; items without
words have no window; repeated documents are judged alike; repeated item ids
count once; a null item id counts as the empty string; an empty benchmark
finds nothing; other columns of either table are ignored, or kept by
``remove_contaminated``, whose working columns carry a prefix.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mktlens.llm.common import ascii_lower, gram_hashes, row_name, word_hashes
from mktlens.sources.sinks import materialize

WINDOW = 10
HASH_BYTES = 64  # a hash in a broadcast set, with its place in the table
SET_BYTES = 384 << 20
BROADCAST_BYTES = 64 << 20
SEPARATORS_RE = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS_RE), "")


def benchmark_windows(bench: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(hash, width, gram, items): each distinct window with the ids that have it."""
    items = bench.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), item_words(F.col(text_col)).alias("words")
    ).where(F.size("words") > 0)
    width = F.least(F.lit(window), F.size("words"))
    grams = items.select(
        "item",
        width.alias("width"),
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("words") - width + 1),
                lambda i: F.slice("words", i, width),
            )
        ).alias("gram_words"),
    )
    grams = grams.withColumn("h", word_hashes(F.col("gram_words")))
    hashed = None
    for n in range(1, window + 1):
        part = gram_hashes(grams.where(F.col("width") == n), "h", n, "g").select(
            _of_width(n)(F.get("g", F.lit(0))).alias("hash"),
            "width",
            F.array_join("gram_words", " ").alias("gram"),
            "item",
        )
        hashed = part if hashed is None else hashed.unionByName(part)
    return hashed.groupBy("hash", "width", "gram").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _of_width(n: int):
    return lambda x: F.xxhash64(x, F.lit(n))


def _with_grams(docs: DataFrame, id_col: str, text_col: str, widths: list[int]) -> DataFrame:
    """(doc_id, row_key, words, grams) of every document: the hashes of its
    windows, those of one width after those of the widths before it."""
    df = docs.select(
        F.col(id_col).alias("doc_id"),
        row_name(F.col(id_col), F.col(text_col)).alias("row_key"),
        item_words(F.col(text_col)).alias("words"),
    )
    df = df.withColumn("h", word_hashes(F.col("words")))
    for n in widths:
        df = gram_hashes(df, "h", n, f"g{n}")
        df = df.withColumn(f"g{n}", F.transform(f"g{n}", _of_width(n)))
    every = F.concat(*[F.col(f"g{n}") for n in widths])
    return df.select("doc_id", "row_key", "words", every.alias("grams"))


def _probed(grams: DataFrame, held: DataFrame) -> DataFrame:
    """(doc_id, row_key, words, place, hash): windows whose hash is in the
    broadcast set, probed where the document stands."""
    # An outer explode: the inner one would put a filter under the columns that
    # make the hashes, which evaluates each of them again and again.
    each = grams.select("doc_id", "row_key", "words", F.posexplode_outer("grams").alias("place", "hash"))
    return each.join(F.broadcast(held), "hash", "left_semi").select("doc_id", "row_key", "words", "place", "hash")


def _candidates(docs: DataFrame, windows: DataFrame, widths: list[int], id_col: str, text_col: str) -> DataFrame:
    """``_probed`` for the whole set: one pass with one broadcast while it is
    within ``SET_BYTES``, else the hashes are written once and probed slice by
    slice, each slice within the bound."""
    held = materialize(windows.select("hash").distinct(), "bench-hashes")
    slices = max(1, math.ceil(held.count() * HASH_BYTES / SET_BYTES))
    grams = _with_grams(docs, id_col, text_col, widths)
    if slices == 1:
        return _probed(grams, held)
    grams = materialize(grams, "doc-windows")
    passes = [
        materialize(_probed(grams, held.where(F.pmod("hash", F.lit(slices)) == k)), "bench-found") for k in range(slices)
    ]
    return reduce(DataFrame.unionByName, passes)


def find_hits(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified hits (doc_id, row_key, start, width, items); start counts from 0."""
    windows = materialize(benchmark_windows(bench), "bench-windows")
    seen = windows.agg(
        F.sort_array(F.collect_set("width")).alias("widths"),
        F.sum(F.length("gram") + 64 + 16 * F.size("items")).alias("bytes"),
    ).first()
    widths = list(seen["widths"]) or [WINDOW]
    found = _candidates(docs, windows, widths, id_col, text_col)

    # A place among all widths to (width, start).
    n = F.size("words")
    width, offset, below = F.lit(None).cast("int"), F.lit(0), F.lit(0)
    for w in widths:
        upto = below + F.greatest(n - (w - 1), F.lit(0))
        width = F.when(width.isNull() & (F.col("place") < upto), F.lit(w)).otherwise(width)
        offset = F.when(F.col("place") >= upto, upto).otherwise(offset)
        below = upto
    start = F.col("place") - offset
    # Join keys that cannot be null: a null check of them would join the words of
    # every window, before the probe.
    width = F.coalesce(width, F.lit(0))
    found = found.select(
        "doc_id",
        "row_key",
        "hash",
        start.alias("start"),
        width.alias("width"),
        F.coalesce(F.array_join(F.slice("words", start + 1, width), " "), F.lit("")).alias("gram"),
    )
    set_side = F.broadcast(windows) if (seen["bytes"] or 0) <= BROADCAST_BYTES else windows
    return found.join(set_side, ["hash", "width", "gram"]).select("doc_id", "row_key", "start", "width", "items")


def _covered(spans: Column) -> Column:
    """Words inside any of the (start, width) spans, which are sorted."""
    step = lambda acc, x: F.struct(
        F.greatest(acc["upto"], x["start"] + x["width"]).alias("upto"),
        (acc["n"] + F.greatest(F.lit(0), x["start"] + x["width"] - F.greatest(acc["upto"], x["start"]))).alias("n"),
    )
    return F.aggregate(
        spans, F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")), step, lambda acc: acc["n"].cast("bigint")
    )


def _disjoint(spans: Column) -> Column:
    """Sorted (start, width) spans to (start, end) that neither overlap nor touch."""
    new = lambda x: F.struct(x["start"].alias("start"), (x["start"] + x["width"]).alias("end"))

    def step(acc, x):
        last = F.element_at(acc, -1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["start"] + x["width"]).alias("end"))
        return F.when((F.size(acc) == 0) | (last["end"] < x["start"]), F.concat(acc, F.array(new(x)))).otherwise(
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(grown))
        )

    return F.aggregate(spans, F.array().cast("array<struct<start:int,end:int>>"), step)


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: (doc_id, n_words, n_hit, items, spans, contaminated)."""
    hits = (
        find_hits(docs, bench, id_col, text_col)
        .groupBy("row_key")
        .agg(
            F.sort_array(F.collect_set(F.struct("start", "width"))).alias("spans"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )
    every = docs.select(
        F.col(id_col).alias("doc_id"),
        row_name(F.col(id_col), F.col(text_col)).alias("row_key"),
        F.size(item_words(F.col(text_col))).cast("bigint").alias("n_words"),
    )
    none = F.array().cast("array<struct<start:int,width:int>>")
    return every.join(hits, "row_key", "left").select(
        "doc_id",
        "row_key",
        "n_words",
        F.when(F.col("spans").isNull(), F.lit(0)).otherwise(_covered(F.col("spans"))).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", none).alias("spans"),
        F.col("spans").isNotNull().alias("contaminated"),
    )


def remove_contaminated(
    docs: DataFrame, bench: DataFrame, mode: str = "documents", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The table without its benchmark passages, with the columns of the input.

    ``documents`` drops every document that holds a window; ``spans`` keeps
    them and cuts the words of the hits (from the first word's start to the
    last word's end) out of their texts, leaving one space.
    """
    if mode not in ("documents", "spans"):
        raise ValueError(f"mode: {mode}")
    hits = find_hits(docs, bench, id_col, text_col)
    left = docs.withColumn("_dc_key", row_name(F.col(id_col), F.col(text_col)))
    if mode == "documents":
        bad = hits.select(F.col("row_key").alias("_dc_key")).distinct()
        return left.join(bad, "_dc_key", "left_anti").select(*docs.columns)
    spans = hits.groupBy(F.col("row_key").alias("_dc_key")).agg(
        F.sort_array(F.collect_set(F.struct("start", "width"))).alias("_dc_spans")
    )
    # A text is word, gap, word, gap ...: gaps are what the word rule leaves.
    text = F.coalesce(F.col(text_col), F.lit(""))
    both = left.join(spans, "_dc_key", "left")
    words = F.regexp_extract_all(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), 0)
    gaps = F.split(text, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", -1)
    # Word and gap as one piece; what is kept lies between the merged hits.
    pieces = F.zip_with(words, F.slice(gaps, 2, F.size(words)), lambda w, g: F.concat(w, g))
    both = (
        both.withColumn("_dc_gaps", gaps)
        .withColumn("_dc_pieces", F.when(F.col("_dc_spans").isNotNull(), pieces))
        .withColumn("_dc_spans", _disjoint(F.col("_dc_spans")))
    )
    run = lambda a, b: F.array_join(F.slice("_dc_pieces", a + 1, b - a), "")
    upto = lambda i: F.coalesce(F.when(i > 0, F.get("_dc_spans", i - 1)["end"]), F.lit(0))
    kept = F.transform(
        "_dc_spans",
        lambda x, i: F.concat(run(upto(i), x["start"]), F.lit(" "), F.get("_dc_gaps", x["end"])),
    )
    last = F.element_at("_dc_spans", -1)["end"]
    cut = F.concat(F.get("_dc_gaps", F.lit(0)), F.array_join(kept, ""), run(last, F.size("_dc_pieces")))
    new = F.when(F.col("_dc_spans").isNull(), F.col(text_col)).otherwise(cut)
    return both.withColumn(text_col, new).select(*docs.columns)
