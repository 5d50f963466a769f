"""Batch build: every layer in dependency order, gated, then published.

Each run writes its views as parquet below a folder of its own (marts by
month), later views reading the written ones, so each mart is computed once
and a lost executor re-reads files. Row counts of raw and staged tables and the
totals of staged tables and marts are observed while these are written; the
fan-out checks compare what was observed, and scan the written tables only if
that does not agree (a stage that ran twice after the loss of an executor may
count twice). Then the grain of every view is tested on its key columns.

Only a run that passes is published: a numbered pointer, written under a name of
its own, names the run's folder, and the greatest number that is complete wins.
Nothing that is published is overwritten or deleted before its successor stands;
the layers' schemas get views on its tables. A run that fails leaves what was
published untouched. ``drop_old_runs`` removes runs that no kept pointer names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mktlens.operators import grain_violations
from mktlens.plans import quality
from mktlens.plans.warehouse import Warehouse
from mktlens.sources import create_view, load_raw

# View -> its declared grain, in dependency order (each reads the ones before).
GRAINS: dict[str, tuple[str, ...]] = {
    "stg_orders": ("order_id",),
    "stg_order_items": ("order_id", "order_item_id"),
    "stg_order_payments": ("order_id", "payment_sequential"),
    "stg_marketing_funnel": ("mql_id",),
    "mart_orders": ("order_id",),
    "mart_order_seller": ("order_id", "seller_id"),
    "mart_marketing_funnel": ("contact_month", "origin"),
    "mart_seller_lifecycle": ("mql_id",),
    "acquisition_channel_quality": ("origin",),
    "seller_activation_performance": ("mql_id",),
    "delivery_review_analysis": ("delivery_delay_bucket",),
    "join_fanout_reconciliation": ("metric_name",),
    "final_kpi_validation": ("metric_name",),
}
# Source tables may repeat their keys (the profiler reports it); every view
# that this build itself groups must not.
STRICT_GRAINS = tuple(v for v in GRAINS if not v.startswith("stg_"))
PARTITIONED = {"mart_orders": "purchase_month", "mart_order_seller": "purchase_month"}
POINTER = "_published"
# Raw tables that exactly one view is made of: its write reads them once.
RAW_OF = {
    "orders": "stg_orders",
    "order_items": "stg_order_items",
    "order_payments": "stg_order_payments",
    "marketing_qualified_leads": "stg_marketing_funnel",
    "closed_deals": "stg_marketing_funnel",
}


class QualityGateFailed(RuntimeError):
    pass


class _Observed(Mapping[str, DataFrame]):
    """Raw tables that count their rows as they are read."""

    def __init__(self, raw: Mapping[str, DataFrame], counts: Mapping[str, Observation]):
        self.spark = raw.spark
        self._raw, self._counts, self._cache = raw, counts, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            df = self._raw[name]
            seen = self._counts.get(name)
            self._cache[name] = df if seen is None else df.observe(seen, F.count("*").alias("rows"))
        return self._cache[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._raw)

    def __len__(self) -> int:
        return len(self._raw)


def build_warehouse(
    spark: SparkSession, source_dir: str, target_dir: str, strict: bool = True, schemas: bool = False
) -> dict[str, str]:
    """Build, check and publish; returns the path of every view of the run.

    With ``strict`` a violated grain or a check that is not PASS raises
    ``QualityGateFailed`` (naming them) before anything is published. With
    ``schemas`` the views are also registered as ``<layer>.<view>``.
    """
    target = target_dir.rstrip("/")
    run_dir = f"{target}/run-{uuid.uuid4().hex}"
    read = {t: Observation(f"raw-{t}") for t in RAW_OF}
    w = Warehouse(_Observed(load_raw(spark, source_dir), read))
    paths: dict[str, str] = {}
    totals: dict[str, dict] = {}
    for name in GRAINS:
        if name == "join_fanout_reconciliation":
            df = _fanout(spark, w, totals)
        else:
            df = getattr(w, name)
        path = f"{run_dir}/{name}"
        seen = Observation(f"view-{name}")
        sums = [F.sum(c).alias(c) for c in quality.FANOUT_MEASURES.get(name, ())]
        writer = df.observe(seen, F.count("*").alias("rows"), *sums).write
        if name in PARTITIONED:
            writer = writer.partitionBy(PARTITIONED[name])
        writer.parquet(path)
        totals[name] = seen.get
        # Views that follow are built from the written table, not derived anew.
        w.__dict__[name] = spark.read.schema(df.schema).parquet(path).select(*df.columns)
        if name == "mart_order_seller":
            w.__dict__["order_seller_facts"] = w.mart_order_seller
        paths[name] = path
    paths["staging_reconciliation"] = f"{run_dir}/staging_reconciliation"
    rows = [(t, view, read[t].get["rows"], totals[view]["rows"]) for t, view in RAW_OF.items()]
    reconciled = spark.createDataFrame(rows, "raw_table string, view string, raw_rows long, staging_rows long")
    reconciled.coalesce(1).write.parquet(paths["staging_reconciliation"])
    if strict:
        bad = [f"grain of {v}" for v in STRICT_GRAINS if not grain_violations(getattr(w, v), GRAINS[v]).isEmpty()]
        bad += _failed_checks(w.join_fanout_reconciliation, w.final_kpi_validation)
        if bad:
            raise QualityGateFailed(f"failed checks: {bad}")
    publish(spark, target, paths)
    if schemas:
        for layer, views in Warehouse.LAYERS.items():
            for v in views:
                create_view(spark, layer, v, getattr(w, v).columns, paths[v])
    return paths


def _fanout(spark: SparkSession, w: Warehouse, totals: Mapping[str, Mapping]) -> DataFrame:
    """The fan-out checks from the observed totals; by a scan of the written
    tables where those do not all agree."""
    checks = quality.fanout_of_totals(spark, totals)
    return w.join_fanout_reconciliation if _failed_checks(checks) else checks


def _pointers(spark: SparkSession, target: str) -> DataFrame | None:
    """(view, path, version) of all pointers that are complete: a pointer is one
    file, which stands only after its commit."""
    try:
        found = spark.read.schema("view string, path string, version long").parquet(f"{target.rstrip('/')}/{POINTER}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return found


def publish(spark: SparkSession, target: str, paths: Mapping[str, str]) -> int:
    """Writes the next pointer and returns its number. Two runs that publish at
    once ask for the same number; the later one finds it taken and asks again."""
    rows = spark.createDataFrame(list(paths.items()), "view string, path string").coalesce(1)
    while True:
        seen = _pointers(spark, target)
        last = None if seen is None else seen.agg(F.max("version").alias("v")).first()["v"]
        version = (last or 0) + 1
        try:
            rows.write.mode("errorifexists").parquet(f"{target.rstrip('/')}/{POINTER}/version={version}")
            return version
        except AnalysisException as e:
            if e.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            if _has_rows(spark, target, version):
                continue
            # an unfinished pointer of a run that was stopped: its number is passed over
            rows.write.mode("append").parquet(f"{target.rstrip('/')}/{POINTER}/version={version}")
            return version


def _has_rows(spark: SparkSession, target: str, version: int) -> bool:
    seen = _pointers(spark, target)
    return seen is not None and not seen.where(F.col("version") == version).isEmpty()


def published(spark: SparkSession, target_dir: str) -> dict[str, str]:
    """View -> path of the last run that passed; empty before the first."""
    seen = _pointers(spark, target_dir)
    if seen is None:
        return {}
    # one row per view: a handful
    last = seen.groupBy("version").agg(F.map_from_entries(F.collect_list(F.struct("view", "path"))).alias("paths"))
    row = last.orderBy(F.col("version").desc()).limit(1).first()
    return {} if row is None else dict(row["paths"])


def drop_old_runs(spark: SparkSession, target_dir: str, keep: int = 2) -> list[str]:
    """Deletes the run folders named by older pointers than the last ``keep``,
    after those pointers themselves; returns the folders. What a kept pointer
    names stays, as do runs that were never published."""
    target = target_dir.rstrip("/")
    seen = _pointers(spark, target)
    if seen is None:
        return []
    folder = F.regexp_extract("path", r"^(.*/run-[0-9a-f]+)/", 1)
    runs = sorted((r["version"], r["run"]) for r in seen.select("version", folder.alias("run")).distinct().collect())
    versions = sorted({v for v, _ in runs})
    old = versions[: max(0, len(versions) - keep)]
    kept = {run for v, run in runs if v not in old}
    gone = [run for v, run in runs if v in old and run not in kept and run.startswith(f"{target}/run-")]
    for path in [f"{target}/{POINTER}/version={v}" for v in old] + gone:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    return gone


def _failed_checks(*checks: DataFrame) -> list[str]:
    out = []
    for c in checks:
        # a check table has one row per metric: a handful of rows
        out += [r.metric_name for r in c.where(F.col("check_status") != "PASS").select("metric_name").collect()]
    return out
