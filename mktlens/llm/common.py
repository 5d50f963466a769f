"""Helpers shared by the document operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The separator characters of the two word rules.
WORD_SPACE = " \t\n\x0b\f\r"  # words are [^\x20\x09-\x0D]+
WORD_SPACE_RE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else (``lower`` does just that on ASCII text)."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def space_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_SPACE_RE), "")


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def gram_hashes(df: DataFrame, hashes: str, n: int, out: str) -> DataFrame:
    """Adds ``out``: the 64-bit hash of every run of ``n`` elements of ``hashes``.

    Runs of 1, 2, 4, ... are built from pairs of the previous length, each in
    a column of its own (an expression used twice would be evaluated twice),
    then the binary parts of ``n`` are put together.
    """
    power, col, done, parts = 1, hashes, 0, []
    made = []
    while power <= n:
        if n & power:
            parts.append((power, col))
        if power * 2 <= n:
            nxt = f"{out}_{power * 2}"
            df = df.withColumn(nxt, F.zip_with(F.col(col), shifted(F.col(col), power), lambda a, b: F.xxhash64(a, b)))
            made.append(nxt)
            col = nxt
        power *= 2
    acc = None
    for width, name in parts:
        if acc is None:
            acc, done = name, width
            continue
        nxt = f"{out}_p{done + width}"
        df = df.withColumn(nxt, F.zip_with(F.col(acc), shifted(F.col(name), done), lambda a, b: F.xxhash64(a, b)))
        made.append(nxt)
        acc, done = nxt, done + width
    whole = F.slice(F.col(acc), 1, F.greatest(F.size(hashes) - (n - 1), F.lit(0)))
    return df.withColumn(out, whole).drop(*made)


def shifted(a: Column, by: int) -> Column:
    """``a`` without its first ``by`` elements."""
    return F.slice(a, by + 1, F.greatest(F.size(a) - by, F.lit(0)))


def row_name(id_col: Column, text: Column) -> Column:
    """``row_key`` beside a second hash with another seed: 128 bits, so that no
    two of some 10^10 rows are taken for one another."""
    t = F.coalesce(text, F.lit(""))
    other = F.xxhash64(F.lit("row"), F.octet_length(t), t, text.isNull(), id_col.cast("string"), id_col.isNull())
    return F.struct(row_key(id_col, text).alias("a"), other.alias("b"))


def row_key(id_col: Column, text: Column) -> Column:
    """Names a row for joining results back: id and text, so that rows that
    repeat an id with another text stay apart. Null-safe."""
    t = F.coalesce(text, F.lit(""))
    return F.xxhash64(id_col.cast("string"), text.isNull(), t, F.octet_length(t))
