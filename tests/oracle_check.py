"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: status, rows, and the first difference found.
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NaT or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "item"):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, datetime.datetime):
        return v
    if isinstance(v, datetime.date):
        return datetime.datetime(v.year, v.month, v.day)
    if v is pd.NaT:
        return None
    return v


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


SPARK_TO_DUCK = {
    "LongType": "BIGINT",
    "IntegerType": "INTEGER",
    "DoubleType": "DOUBLE",
    "StringType": "VARCHAR",
    "DateType": "DATE",
    "TimestampNTZType": "TIMESTAMP",
    "BooleanType": "BOOLEAN",
}


def type_diff(spark_schema, duck_desc) -> list:
    """Columns whose Spark type and DuckDB type differ."""
    duck = {d[0]: str(d[1]).upper() for d in duck_desc}
    out = []
    for f in spark_schema.fields:
        s = SPARK_TO_DUCK.get(type(f.dataType).__name__, type(f.dataType).__name__)
        d = duck.get(f.name, "?")
        if not (d == s or (s == "VARCHAR" and d.startswith("VARCHAR"))):
            out.append((f.name, s, d))
    return out


def compare(name: str, sdf: pd.DataFrame, odf: pd.DataFrame) -> str:
    if sorted(sdf.columns) != sorted(odf.columns):
        return f"COLUMNS spark={sorted(sdf.columns)} oracle={sorted(odf.columns)}"
    if len(sdf) != len(odf):
        return f"ROWS spark={len(sdf)} oracle={len(odf)}"
    a, b = rows_of(sdf), rows_of(odf)
    for ra, rb in zip(a, b):
        if ra != rb:
            cols = sorted(sdf.columns)
            diff = [(c, x, y) for c, x, y in zip(cols, ra, rb) if x != y]
            return f"VALUES first diff {diff[:4]}"
    return "OK"


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from pyspark.sql import SparkSession

    import __spark_entry__ as E

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{name:40s} SPARK-ERROR {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sql:
            print(f"{name:40s} rows-only rows={len(sdf)} spark={ts:.2f}s")
            continue
        try:
            cur = con.execute(sql[name])
            tdiff = type_diff(qs[name](spark, sf_dir).schema, cur.description)
            odf = cur.fetchdf()
        except Exception as e:  # noqa: BLE001
            print(f"{name:40s} ORACLE-ERROR {str(e)[:300]}")
            bad += 1
            continue
        res = compare(name, sdf, odf)
        if res == "OK" and tdiff:
            res = f"TYPES {tdiff}"
        if res != "OK":
            bad += 1
        print(f"{name:40s} {res} rows={len(sdf)} spark={ts:.2f}s")
    print(f"mismatches: {bad}")


if __name__ == "__main__":
    main()
