"""The registered queries of the document operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mktlens.llm import (
    decontaminate,
    licenses,
    oracle,
    ordinal,
    pii,
    quality_rules,
    secrets,
    sentencepiece_lattice,
    shards,
    simhash,
    spelling,
    substring_dedup,
    token_alignment,
    toxicity,
)
from mktlens.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = dict(oracle.SQL)


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.shard(table(spark, sf_dir, "documents"), 16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@register
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@register
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id",
        *[F.col(f"quality.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")],
        F.col("quality_kept").alias("kept"),
    )


@register
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register
def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_report(table(spark, sf_dir, "documents"))
    of = lambda *kinds: F.filter("finds", lambda x: x["kind"].isin(*kinds))
    count = lambda kind: F.size(of(kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(k) for k in secrets.BASE_KINDS],
        F.sha2(secrets.spans_text(of(*secrets.BASE_KINDS)), 256).alias("base_sha256"),
        secrets.spans_text(F.col("finds")).alias("spans"),
    )


@register
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal.quality_grades(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op3_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_lattice.encode(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "sample",
        F.size("ids").cast("bigint").alias("n_ids"),
        "log_prob",
        "perturbed",
        "inclusion",
        "round_trip",
        "ids",
    )


@register
def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    span = lambda x: F.concat_ws(":", x["family"], x["start"].cast("string"), x["end"].cast("string"))
    return found.select(
        "doc_id",
        "n_paragraphs",
        F.size("finds").cast("bigint").alias("n_licenses"),
        F.array_join(F.sort_array(F.array_distinct("finds.family")), ",").alias("families"),
        F.array_join(F.transform("finds", span), ",").alias("spans"),
        F.round(F.coalesce(F.array_max("finds.probability"), F.lit(0.0)), 6).alias("probability"),
    )


@register
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"))


@register
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), drop_every=97)


@register
def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("finds", lambda x: x["base"])
    count = lambda kind: F.size(F.filter("finds", lambda x: x["base"] & (x["kind"] == kind))).cast("bigint")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.spans_text(base), 256).alias("base_sha256"),
        pii.spans_text(F.col("finds")).alias("spans"),
    )
