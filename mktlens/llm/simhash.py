"""SimHash near-duplicate groups by covering locality-sensitive hashing.

* Fingerprint: 64 bits; a bit is set if it is set in over half of the XXH64
  (seed 42) hashes of the text's word shingles, repeats included. Words are
  ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; fewer words than a
  shingle are one shingle; no words give fingerprint zero.
* Candidates: for a radius r, bit i gets a non-zero vector m(i) of r+1 bits,
  and table v (each non-zero v) masks the bits with <m(i), v> = 1 (mod 2). For
  any r bit places some v is orthogonal to all their vectors, so that table
  masks none of them and the pair shares a bucket: no pair within the radius
  is missed. Radius 2 takes 7 tables with 36 or 37 masked bits each.
* Links: equal fingerprints collapse first. Within a crowded bucket no pairs
  are formed. A member names the centres around it: itself and, for radius 2,
  itself with one unmasked bit flipped. Two fingerprints differ in at most 2
  bits exactly if they share a centre, and a centre has at most 65 members;
  each is linked to the centre's smallest, which is verified by bit count.
* Groups: connected components of the links (``components``).

Defined results: null, empty and blank texts have fingerprint zero, linked like
any other; very long texts are hashed in blocks; a null id never becomes a
component id unless the whole component has none; repeated rows are one group;
other columns are untouched, working columns carry a prefix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mktlens.llm.common import row_name
from mktlens.llm.components import components
from mktlens.sources.sinks import materialize

BITS = 64
SHINGLE = 3
RADIUS = 2
SEED = 42
BLOCK = 1 << 16  # shingles whose bits are unpacked at a time


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII space only
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, SEED) for g in grams), dtype="<u8", count=n)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, BLOCK):
        block = hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint_udf(shingle: int = SHINGLE):
    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            prints = np.fromiter((fingerprint(t, shingle) for t in s), dtype=np.uint64, count=len(s))
            yield pd.Series(prints.view(np.int64))

    return of


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def masks(radius: int = RADIUS) -> list[int]:
    """One mask of signed 64 bits for every non-zero vector v of radius+1 bits."""
    top = (1 << (radius + 1)) - 1
    out = []
    for v in range(1, top + 1):
        mask = sum(1 << i for i in range(BITS) if ((i % top + 1) & v).bit_count() % 2)
        out.append(_signed(mask))
    return out


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def near_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links that connect exactly the distinct fingerprints ``fp``
    within ``radius`` bits (0, 1 or 2) of each other, through chains."""
    if radius not in (0, 1, 2):
        raise ValueError("centres of one flipped bit join fingerprints up to 2 bits apart")
    table = masks(radius)
    buckets = prints.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in table])).alias("v", "bucket"),
    )
    crowded = buckets.groupBy("v", "bucket").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    members = (
        buckets.join(crowded, ["v", "bucket"], "left_semi")
        .groupBy("fp")
        .agg(F.bit_or(F.element_at(F.array(*[F.lit(~m) for m in table]), F.col("v") + 1)).alias("free"))
    )
    # Radius 1 compares members as centres of their own on one side only: a
    # fingerprint is also a member of its own centre, so flipped centres that
    # are no fingerprints would join pairs two bits apart; they are checked out.
    flips = F.array(*[F.lit(_signed(1 << i)) for i in range(BITS)])
    around = F.transform(
        F.filter(flips, lambda b: F.col("free").bitwiseAND(b) != 0), lambda b: F.col("fp").bitwiseXOR(b)
    )
    centres = members.select("fp", F.explode(F.concat(F.array("fp"), around)).alias("centre"))
    grouped = centres.groupBy("centre").agg(F.collect_set("fp").alias("near")).where(F.size("near") > 1)
    if radius == 1:
        grouped = grouped.where(F.array_contains("near", F.col("centre"))).withColumn("hub", F.col("centre"))
    else:
        grouped = grouped.withColumn("hub", F.array_min("near"))
    links = grouped.select(F.explode("near").alias("a"), F.col("hub").alias("b")).distinct()
    return links.where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))


def _grouped_prints(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int):
    """The fingerprint of every row, and the group of every fingerprint."""
    rows = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            row_name(F.col(id_col), F.col(text_col)).alias("row_key"),
            fingerprint_udf(shingle)(F.col(text_col)).alias("fp"),
        ),
        "fingerprints",
    )
    distinct = rows.groupBy("fp").agg(
        F.min("doc_id").alias("least_doc"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("first"),
    )
    distinct = materialize(distinct, "distinct-fingerprints")
    linked = materialize(
        distinct.join(components(near_links(distinct.select("fp"), radius)).withColumnRenamed("vertex", "fp"), "fp"),
        "linked-fingerprints",
    )
    groups = linked.groupBy("root").agg(F.min("least_doc").alias("component_id"), F.min("first").alias("keep"))
    named = linked.select("fp", "root").join(groups, "root").select("fp", "component_id", "keep")
    alone = distinct.join(linked, "fp", "left_anti").select(
        "fp", F.col("least_doc").alias("component_id"), F.col("first").alias("keep")
    )
    return rows, named, alone


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    The last join is from rows to fingerprints; a fingerprint that a third of
    all rows share is a skewed key of that join alone, which Spark splits."""
    rows, named, alone = _grouped_prints(docs, id_col, text_col, shingle, radius)
    ids = named.unionAll(alone).select("fp", "component_id")
    return rows.join(ids, "fp", "left").select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """One row of each group, that of the smallest id; columns of the input.

    Whole rows travel once, by the hash of id and text, which repeats only
    where rows do; of rows that repeat id and text one stays."""
    _, named, alone = _grouped_prints(docs, id_col, text_col, shingle, radius)
    keep = named.unionAll(alone).select(F.col("keep.row_key").alias("_nd_key")).distinct()
    keyed = docs.withColumn("_nd_key", row_name(F.col(id_col), F.col(text_col)))
    kept = keyed.join(keep, "_nd_key", "left_semi")
    return kept.dropDuplicates(["_nd_key"]).select(*docs.columns)
