"""Sinks: views, layers, materialised marts, JSON reports."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared scratch folder: ``spark.checkpoint.dir`` of the
    session, else the context's checkpoint directory.

    Where neither is set, a session in one process (master ``local``) gets a
    private temporary folder; on a cluster, where executors could not see it,
    that is an error. The session config itself is never changed.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="mktlens-ckpt-")
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_dir(spark)}/mktlens/{label}-{uuid.uuid4().hex}"


def ensure_layer(spark: SparkSession, name: str) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` for a layer (raw, staging, marts, ...)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def create_view(spark: SparkSession, layer: str, name: str, columns: list[str], path: str) -> None:
    """``CREATE OR REPLACE VIEW <layer>.<name>`` over a written table."""
    ensure_layer(spark, layer)
    listed = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"CREATE OR REPLACE VIEW `{layer}`.`{name}` AS SELECT {listed} FROM parquet.`{path}`")


def register(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """``CREATE OR REPLACE VIEW``: a logical, non-materialised view."""
    df.createOrReplaceTempView(name)
    return spark.table(name)


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared folder and read it back.

    This cuts lineage durably (a lost executor re-reads files, never a local
    checkpoint) and lets several consumers inside one plan, or several plans,
    read one computation. Unlike ``checkpoint()`` it runs the input once, and
    the scan gives AQE real file sizes for its join choices.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)


def write_profile(df: DataFrame, path: str) -> None:
    """JSON-lines sink for profile reports (one object per row)."""
    df.write.mode("overwrite").json(path)


def write_report(parts: dict[str, DataFrame], path: str) -> dict[str, str]:
    """Every part of a report as JSON lines below ``path``, in a folder of its
    own; returns the folders."""
    folders = {name: f"{path.rstrip('/')}/{name}" for name in parts}
    for name, df in parts.items():
        write_profile(df, folders[name])
    return folders
