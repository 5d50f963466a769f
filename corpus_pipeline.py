"""From raw documents to encoded training text, in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and reread as the next
one's ``docs``. Each stage works on all rows its predecessor kept:

1. quality rules: documents that break a rule go;
2. SimHash near-dedup: of each group the row with the smallest id stays
   (3-word shingles, fingerprints at most 2 bits apart);
3. benchmark decontamination: documents that hold a window of a benchmark
   item go;
4. secret scans: spans of secrets are masked, all documents stay;
5. SentencePiece: every document is encoded, as two sampled segmentations
   without replacement.

All but the last return the columns of ``documents``. Null, empty and repeated
rows and extra columns are handled as the operators' docstrings say; an empty
table gives empty stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mktlens.llm import decontaminate, quality_rules, secrets, sentencepiece_lattice, simhash
from mktlens.llm.common import table
from mktlens.sources.sinks import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_quality(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs, shingle=3, radius=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"), mode="documents")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact_secrets(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, sample, ids, log_prob, perturbed, inclusion)."""
    return sentencepiece_lattice.encode(docs).select("doc_id", "sample", "ids", "log_prob", "perturbed", "inclusion")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", keep_quality),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", mask_secrets),
    ("sentencepiece encoding", encode),
]

# The fingerprint and the lattice search have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
