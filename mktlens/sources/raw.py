"""Scans of the raw layer: parquet/CSV tables, file discovery, inventory."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mktlens.sources import adapters
from mktlens.sources.csv_records import csv_records
from mktlens.sources.schemas import RAW_SCHEMAS


class RawTables(Mapping[str, DataFrame]):
    """Lazily built raw tables of one data directory.

    If the directory holds the marketplace tables themselves
    (``<table>.parquet``) they are scanned with the contract schema; otherwise
    each table is derived from the TPC-H-like test tables by its adapter.
    Building a DataFrame runs no job; every table is created once per object.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}
        self.native = read_table(spark, f"{self.sf_dir}/marketing_qualified_leads.parquet") is not None

    def __getitem__(self, name: str) -> DataFrame:
        if name not in RAW_SCHEMAS:
            raise KeyError(name)
        if name not in self._cache:
            self._cache[name] = self._build(name)
        return self._cache[name]

    def as_found(self, name: str) -> DataFrame:
        """The table's source as it arrives, before any conforming: the table's
        own file, or the test table that its adapter reads first."""
        source = name if self.native else adapters.SOURCE_OF.get(name)
        found = source and read_table(self.spark, f"{self.sf_dir}/{source}.parquet")
        if not found:
            raise KeyError(f"{name} has no source in {self.sf_dir}")
        return found

    def _build(self, name: str) -> DataFrame:
        if self.native:
            return scan_table(self.spark, f"{self.sf_dir}/{name}.parquet", RAW_SCHEMAS[name])
        if name not in adapters.ADAPTERS:
            raise KeyError(f"{name} has no source in {self.sf_dir}")
        return adapters.ADAPTERS[name](self.spark, self.sf_dir)

    def __iter__(self):
        return iter(n for n in RAW_SCHEMAS if self.native or n in adapters.ADAPTERS)

    def __len__(self) -> int:
        return sum(1 for _ in self)


def load_raw(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(spark, sf_dir)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet scan of a path in any store Spark reads; None if there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def scan_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet scan conformed to a contract schema (by name, cast to type).

    An absent contract column is an error: filled with NULL it would empty
    every layer that filters on it. Other columns are dropped here; the drift
    report names them."""
    df = spark.read.parquet(path)
    absent = [f.name for f in schema.fields if f.name not in df.columns]
    if absent:
        raise ValueError(f"{path} lacks the columns {', '.join(absent)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


# CSV dialect of the raw exports: header row, optional UTF-8 BOM, quoted
# fields that may hold line breaks, doubled quotes inside quotes, and
# whitespace kept verbatim (cleaning is the staging layer's job).
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "dateFormat": "yyyy-MM-dd",
}
# Read, but never written: ISO's T, and milliseconds.
READ_TIMESTAMP = "yyyy-MM-dd['T'][ ]HH:mm:ss[.SSSSSS][.SSS]"


MOST_HEADERS = 100


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read raw CSV exports.

    With a schema, files are read in splits and records cut in parallel
    (``csv_records``), quoted line breaks kept; the header of each file is
    matched by name, so a reordered file still binds its columns, a column that
    the contract lacks is left out and one that a file lacks is an error. An
    empty field, quoted or not, reads as NULL; every consumer treats NULL and
    blank text alike. A value that does not parse as its column's type, or a
    record of another width, stops the read: as NULL it would drop its row
    unseen in staging. The distinct headers (at most ``MOST_HEADERS``) reach the
    driver. Without a schema Spark infers one, a file per task.
    """
    if schema is None:
        reader = spark.read.options(**CSV_OPTIONS).option("multiLine", True).option("enforceSchema", False)
        return reader.options(mode="FAILFAST", timestampNTZFormat=READ_TIMESTAMP).csv(path)
    records = csv_records(spark, path)
    files = records.where("is_first").select(F.col("file").alias("_file"), F.col("record").alias("_header"))
    headers = [r["_header"] for r in files.select("_header").distinct().limit(MOST_HEADERS + 1).collect()]
    if len(headers) > MOST_HEADERS:
        raise ValueError(f"{path} has over {MOST_HEADERS} different headers")
    if not headers:
        return spark.createDataFrame([], schema)
    data = records.where(~F.col("is_first"))
    if len(headers) > 1:
        data = data.join(files, F.col("file") == F.col("_file"))
    options = {k: v for k, v in CSV_OPTIONS.items() if k not in ("header", "encoding")}
    options |= {"mode": "FAILFAST", "timestampNTZFormat": READ_TIMESTAMP}
    parsed = None
    for header in headers:
        names = next(csv.reader([header], quotechar='"', doublequote=True))
        absent = [f.name for f in schema.fields if f.name not in names]
        if absent:
            raise ValueError(f"{path} lacks the columns {', '.join(absent)}")
        found = T.StructType([schema[n] if n in schema.names else T.StructField(n, T.StringType()) for n in names])
        row = F.from_csv("record", F.lit(found.toDDL()), options)
        row = F.struct(*[row[f.name].alias(f.name) for f in schema.fields])
        parsed = row if parsed is None else F.when(F.col("_header") == header, row).otherwise(parsed)
    return data.select(parsed.alias("r")).select("r.*")


def write_csv(df: DataFrame, path: str) -> None:
    """Write ``df`` in the same CSV dialect ``read_csv`` reads."""
    df.write.options(**CSV_OPTIONS).mode("errorifexists").csv(path)


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Recursive listing of ``root`` as (path, name, size_bytes); contents are
    never read because only metadata columns are selected."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    return files.select(
        F.col("path"),
        F.regexp_extract(F.col("path"), r"([^/]+)$", 1).alias("name"),
        F.col("length").alias("size_bytes"),
    )


def list_tables(spark: SparkSession, root: str, ending: str = ".parquet") -> DataFrame:
    """The table files below ``root`` as (path, name, size_bytes): what a path
    has up to its first part with this ending. A folder of that name is one table
    however many files it holds."""
    # up to the end of the first part of the path that has the ending
    cut = F.regexp_extract(F.col("path"), r"^(.*?" + ending.replace(".", r"\.") + r")(?:/.*)?$", 1)
    return (
        list_files(spark, root)
        .withColumn("path", cut)
        .where(F.col("path") != "")
        .groupBy("path")
        .agg(F.sum("size_bytes").cast("bigint").alias("size_bytes"))
        .select("path", F.regexp_extract(F.col("path"), r"([^/]+)$", 1).alias("name"), "size_bytes")
    )


def find_source(spark: SparkSession, root: str, name: str) -> str:
    """The single file called ``name`` below ``root``; error on 0 or >1."""
    found = list_files(spark, root, name).select("path").limit(2).collect()
    if len(found) != 1:
        raise FileNotFoundError(f"Expected exactly one {name} below {root}; found {len(found)}")
    return found[0].path


def find_tables(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, str]:
    """``find_source`` for several table files or folders from one listing; at
    most one row for each name and one more reaches the driver."""
    names = list(names)
    listed = list_tables(spark, root).where(F.col("name").isin(names))
    found = {r["name"]: r for r in listed.groupBy("name").agg(F.count("*").alias("n"), F.min("path").alias("path")).collect()}
    for name in names:
        n = found[name]["n"] if name in found else 0
        if n != 1:
            raise FileNotFoundError(f"Expected exactly one {name} below {root}; found {n}")
    return {name: found[name]["path"] for name in names}


def require_file_set(found: DataFrame, expected: Iterable[str]) -> None:
    """Stops a load whose files are not the expected ones, naming those that are
    missing, extra or there twice."""
    bad = file_set_diff(found, expected).where(F.col("status") != "ok").orderBy("name").limit(100).collect()
    if bad:
        raise FileNotFoundError("file set mismatch: " + ", ".join(f"{r['name']} {r['status']}" for r in bad))


def file_set_diff(found: DataFrame, expected: Iterable[str]) -> DataFrame:
    """Compare found file names with the expected set.

    Returns (name, found_count, status) with status ``ok``, ``missing``,
    ``extra`` or ``duplicate``; any non-``ok`` row is fatal for a load.
    """
    spark = found.sparkSession
    exp = spark.createDataFrame([(n,) for n in sorted(set(expected))], "name string")
    counts = found.groupBy("name").agg(F.count("*").cast("bigint").alias("found_count"))
    both = exp.withColumn("is_expected", F.lit(True)).join(counts, "name", "full")
    status = (
        F.when(F.col("found_count").isNull(), "missing")
        .when(F.col("is_expected").isNull(), "extra")
        .when(F.col("found_count") > 1, "duplicate")
        .otherwise("ok")
    )
    return both.select(
        "name", F.coalesce(F.col("found_count"), F.lit(0)).cast("bigint").alias("found_count"), status.alias("status")
    )


def file_inventory(spark: SparkSession, sf_dir: str, names: Iterable[str]) -> DataFrame:
    """Per data file of the named tables: path, name, size and rows, from the
    hidden ``_metadata`` column of one scan per table."""
    out = None
    for name in sorted(names):
        meta = F.col("_metadata")
        files = (
            spark.read.parquet(f"{sf_dir}/{name}.parquet")
            .groupBy(meta["file_path"].alias("path"), meta["file_name"].alias("name"), meta["file_size"].alias("size_bytes"))
            .agg(F.count("*").cast("bigint").alias("rows"))
            .select(F.lit(name).alias("table_name"), "path", "name", "size_bytes", "rows")
        )
        out = files if out is None else out.unionByName(files)
    return out


def table_inventory(spark: SparkSession, sf_dir: str, names: Iterable[str]) -> DataFrame:
    """Per table: row count and storage size in bytes and MB (2 dp), sorted by name."""
    names = list(names)
    every = spark.createDataFrame([(n,) for n in names], "table_name string")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return (
        every.join(file_inventory(spark, sf_dir, names), "table_name", "left")
        .groupBy("table_name")
        .agg(total("rows").alias("row_count"), total("size_bytes").alias("size_bytes"))
        .withColumn("size_mb", F.round(F.col("size_bytes") / 1024 / 1024, 2))
        .orderBy("table_name")
    )
