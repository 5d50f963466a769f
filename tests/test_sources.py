import os
import tempfile

import pytest
from pyspark.sql import functions as F

from mktlens.operators import comparison_table, join_coverage
from mktlens.sources import file_set_diff, find_source, list_files, read_csv
from mktlens.sources.schemas import RAW_SCHEMAS


def test_csv_dialect(spark):
    d = tempfile.mkdtemp(prefix="mktlens-csv-")
    text = (
        "﻿mql_id,first_contact_date,landing_page_id,origin\r\n"
        'm1,2018-01-02,lp1,"paid\nsearch"\r\n'
        'm2,2018-01-03,"say ""hi""",""\r\n'
        "m3,2018-01-04,,organic\r\n"
    )
    with open(os.path.join(d, "leads.csv"), "w", encoding="utf-8", newline="") as fh:
        fh.write(text)
    rows = {r.mql_id: r for r in read_csv(spark, d, RAW_SCHEMAS["marketing_qualified_leads"]).collect()}
    assert set(rows) == {"m1", "m2", "m3"}
    assert rows["m1"].origin == "paid\nsearch"
    # an empty field, quoted or not, reads as NULL; staging and the profiler
    # treat NULL and blank alike
    assert rows["m2"].landing_page_id == 'say "hi"' and rows["m2"].origin is None
    assert rows["m3"].landing_page_id is None
    assert str(rows["m1"].first_contact_date) == "2018-01-02"


def test_find_source_and_file_set(spark):
    d = tempfile.mkdtemp(prefix="mktlens-files-")
    os.makedirs(os.path.join(d, "a", "b"))
    for p in ("a/x.csv", "a/b/y.csv", "a/b/x.csv"):
        with open(os.path.join(d, p), "w") as fh:
            fh.write("h\n1\n")
    assert find_source(spark, d, "y.csv").endswith("a/b/y.csv")
    with pytest.raises(FileNotFoundError):
        find_source(spark, d, "x.csv")
    with pytest.raises(FileNotFoundError):
        find_source(spark, d, "z.csv")
    got = {r.name: r.status for r in file_set_diff(list_files(spark, d, "*.csv"), ["x.csv", "z.csv"]).collect()}
    assert got == {"x.csv": "duplicate", "y.csv": "extra", "z.csv": "missing"}


def test_join_coverage(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), ("",), (None,)], "k string")
    right = spark.createDataFrame([("a",), ("c",)], "k string")
    r = join_coverage(left, "k", right, "k").first()
    assert (r.distinct_left_keys, r.matched_left_keys, r.unmatched_left_keys, r.match_rate) == (2, 1, 1, 0.5)


def test_comparison_fail_paths(spark):
    src = spark.createDataFrame([(1,), (2,)], "x long")
    dup = src.unionAll(src.where("x = 1"))
    one = src.select(F.count("*")).scalar()
    t = comparison_table(src, [("rows", one, dup.select(F.count("*")).scalar()), ("same", one, one)], "bigint")
    got = {r.metric_name: (r.difference, r.check_status) for r in t.collect()}
    assert got == {"rows": (1, "FAIL"), "same": (0, "PASS")}


# ---------------------------------------------------------------- lost input


def _csv(spark, text):
    d = tempfile.mkdtemp(prefix="mktlens-csv-")
    with open(os.path.join(d, "x.csv"), "w", encoding="utf-8", newline="") as fh:
        fh.write(text)
    return read_csv(spark, d, RAW_SCHEMAS["closed_deals"].__class__(RAW_SCHEMAS["closed_deals"].fields[:5]))


def test_iso_timestamps_are_read(spark):
    head = "mql_id,seller_id,sdr_id,sr_id,won_date\r\n"
    rows = "a,s,,,2018-01-01T10:00:00\r\nb,s,,,2018-01-01 10:00:00\r\nc,s,,,2018-01-01 10:00:00.123\r\nd,s,,,\r\n"
    got = {r.mql_id: r.won_date and r.won_date.isoformat() for r in _csv(spark, head + rows).collect()}
    assert got == {"a": "2018-01-01T10:00:00", "b": "2018-01-01T10:00:00", "c": "2018-01-01T10:00:00.123000", "d": None}


def test_unparsable_value_stops_the_read(spark):
    with pytest.raises(Exception, match="yesterday|MALFORMED"):
        _csv(spark, "mql_id,seller_id,sdr_id,sr_id,won_date\r\na,s,,,yesterday\r\n").collect()


def test_absent_column_or_table_is_an_error(spark):
    from mktlens.plans import profiling
    from mktlens.sources import load_raw, scan_table

    d = tempfile.mkdtemp(prefix="mktlens-absent-")
    raw = load_raw(spark, "/root/testdata/sf0.001")
    raw["sellers"].drop("seller_id").write.parquet(f"{d}/sellers.parquet")
    with pytest.raises(ValueError, match="seller_id"):
        scan_table(spark, f"{d}/sellers.parquet", RAW_SCHEMAS["sellers"])
    tables = {t: raw[t] for t in raw if t != "customers"}
    with pytest.raises(KeyError):
        profiling.coverage_report(tables)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_raw(spark, d)["orders"].count()


def test_drift_of_a_table_as_it_arrives(spark):
    from mktlens.plans import profiling
    from mktlens.sources import load_raw

    d = tempfile.mkdtemp(prefix="mktlens-drift-")
    raw = load_raw(spark, "/root/testdata/sf0.001")
    raw["marketing_qualified_leads"].write.parquet(f"{d}/marketing_qualified_leads.parquet")
    changed = raw["orders"].drop("order_status").withColumn("note", F.lit("x"))
    changed.write.parquet(f"{d}/orders.parquet")
    native = load_raw(spark, f"file://{d}")  # found by Spark, not by the local file system
    assert native.native
    found = native.as_found("orders")
    row = profiling.profile_table(raw["orders"], "orders", found=found).first()
    assert (row.column_count, row.missing_expected_columns, row.unexpected_columns) == (8, "order_status", "note")
    assert row.schema_status == "REVIEW"
    good = profiling.profile_table(raw["orders"], "orders", found=native.as_found("marketing_qualified_leads").limit(0)).first()
    assert good.schema_status == "REVIEW"


def test_no_shared_folder_on_a_cluster_is_an_error(spark):
    from mktlens.sources.sinks import shared_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


# ---------------------------------------------------------------- activation


def test_every_deal_counts_once_per_row(spark):
    import datetime as dt

    from conftest import raw_frame

    from mktlens.plans import profiling

    D = dt.datetime
    leads = [{"mql_id": "m1", "origin": "a"}, {"mql_id": "m1", "origin": "a"}, {"mql_id": "m2", "origin": None}]
    deals = [
        {"mql_id": "m1", "seller_id": "s1", "won_date": D(2020, 1, 3)},
        {"mql_id": "m1", "seller_id": "s1", "won_date": D(2020, 1, 3)},
        {"mql_id": "m2", "seller_id": None, "won_date": D(2020, 1, 3)},
        {"mql_id": "m3", "seller_id": "s1", "won_date": None},
    ]
    orders = [{"order_id": "o1", "order_purchase_timestamp": D(2020, 1, 2, 8)}, {"order_id": "o2", "order_purchase_timestamp": D(2020, 1, 9, 8)}]
    items = [{"order_id": o, "order_item_id": 1, "product_id": "p", "seller_id": "s1", "price": 1.0, "freight_value": 0.0} for o in ("o1", "o2")]
    frames = [
        raw_frame(spark, t, r)
        for t, r in (("marketing_qualified_leads", leads), ("closed_deals", deals), ("order_items", items), ("orders", orders))
    ]
    r = profiling.activation_summary(*frames).first()
    assert (r.closed_deals, r.closed_sellers_with_any_order, r.post_win_activated_sellers, r.sellers_with_pre_win_orders) == (4, 3, 2, 2)
    assert r.median_days_to_first_post_win_sale == 6.0
    by = {x.origin: (x.mqls, x.closed_deals, x.post_win_activated_sellers) for x in profiling.activation_by_origin(*frames).collect()}
    assert by == {"a": (2, 2, 2), "unknown": (1, 2, 0)}


def test_table_files_and_folders_are_listed_and_required(spark):
    from mktlens.sources import find_tables, list_tables, require_file_set

    d = tempfile.mkdtemp(prefix="mktlens-tables-")
    one = spark.range(5)
    one.coalesce(1).write.parquet(os.path.join(d, "a.parquet"))
    one.repartition(3).write.parquet(os.path.join(d, "sub", "b.parquet"))
    one.write.parquet(os.path.join(d, "other", "a.parquet"))
    with open(os.path.join(d, "note.txt"), "w") as fh:
        fh.write("x")
    rows = {(r["name"], r["path"].removeprefix("file:").removeprefix(d + "/")) for r in list_tables(spark, d).collect()}
    assert rows == {("a.parquet", "a.parquet"), ("a.parquet", "other/a.parquet"), ("b.parquet", "sub/b.parquet")}
    got = {r["name"]: (r["found_count"], r["status"]) for r in file_set_diff(list_tables(spark, d), ["a.parquet", "c.parquet"]).collect()}
    assert got == {"a.parquet": (2, "duplicate"), "b.parquet": (1, "extra"), "c.parquet": (0, "missing")}
    with pytest.raises(FileNotFoundError, match="a.parquet duplicate, b.parquet extra, c.parquet missing"):
        require_file_set(list_tables(spark, d), ["a.parquet", "c.parquet"])
    require_file_set(list_tables(spark, os.path.join(d, "sub")), ["b.parquet"])
    assert spark.read.parquet(find_tables(spark, d, ["b.parquet"])["b.parquet"]).count() == 5
    for bad in ("a.parquet", "c.parquet"):
        with pytest.raises(FileNotFoundError, match=bad):
            find_tables(spark, d, ["b.parquet", bad])


def test_coverages_match_pairs(spark):
    import random

    from mktlens.operators import coverages

    rng = random.Random(9)
    values = ["", None, *[f"k{i}" for i in range(12)]]
    tables = {
        t: spark.createDataFrame([(rng.choice(values), rng.choice(values)) for _ in range(n)], "x string, `y z` string")
        for t, n in (("a", 40), ("b", 9), ("c", 6), ("d", 0))
    }
    relationships = [
        ("r1", "a", "x", "b", "x"),
        ("r2", "c", "x", "b", "x"),
        ("r3", "a", "x", "c", "x"),
        ("r4", "a", "y z", "c", "y z"),
        ("r5", "d", "x", "a", "x"),
        ("r6", "b", "y z", "d", "y z"),
    ]
    df = coverages(tables, relationships)
    got = {r["relationship"]: tuple(r)[1:] for r in df.collect()}
    for name, lt, lc, rt, rc in relationships:
        want = join_coverage(tables[lt], f"`{lc}`", tables[rt], f"`{rc}`").first()
        assert got[name] == (f"{lt}.{lc}", f"{rt}.{rc}", *want)
    plan = coverages(tables, relationships)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(domain#") == 2 and "Join" not in plan


def test_report_of_all_parts(spark):
    from mktlens.plans.profiling import null_counts, profile_report
    from mktlens.sources import load_raw, write_report

    sf = "/root/testdata/sf0.001"
    raw = load_raw(spark, sf)
    sizes = spark.createDataFrame([(t, 100 + i) for i, t in enumerate(sorted(raw))], "table_name string, size_bytes long")
    folders = write_report(profile_report(raw, sizes), tempfile.mkdtemp(prefix="mktlens-report-") + "/r")
    back = {name: spark.read.json(path) for name, path in folders.items()}
    assert set(back) == {"files", "null_counts", "join_coverage", "activation", "activation_by_origin"}
    assert {r["table_name"]: r["size_bytes"] for r in back["files"].collect()} == {r[0]: r[1] for r in sizes.collect()}
    assert back["join_coverage"].count() == 9 and back["activation"].count() == 1
    odd = spark.createDataFrame([("", 1), (None, None)], "`it's` string, `a``b.c` int")
    assert [tuple(r) for r in null_counts(odd, "t").collect()] == [("t", "it's", 1, 2), ("t", "a`b.c", 2, 1)]


@pytest.mark.parametrize("split", [7, 64, 1 << 20])
def test_records_are_cut_alike_in_any_splits(spark, split):
    """Quoted line breaks, doubled quotes, blank lines and fields longer than a
    split, against the standard library's reader of the whole file."""
    import csv
    import io
    import random

    from pyspark.sql import types as T

    from mktlens.sources.csv_records import csv_records

    rng = random.Random(split)
    d = tempfile.mkdtemp(prefix="mktlens-split-")
    fields = ["plain", 'say ""hi""', "two\nlines", "a,b", "", "\n\n", 'x"y', "é日本😀", "\r\n", "long " * 30, " kept "]
    want = []
    for n in range(3):
        rows = [[f"{n}-{i}", rng.choice(fields), rng.choice(fields)] for i in range(25)]
        want += [tuple(x or None for x in r) for r in rows]
        text = io.StringIO()
        order = [0, 1, 2] if n != 1 else [2, 0, 1]
        names = ["k", "a", "b"]
        writer = csv.writer(text, lineterminator="\r\n" if n == 2 else "\n")
        writer.writerow([names[i] for i in order])
        writer.writerows([[r[i] for i in order] for r in rows])
        with open(os.path.join(d, f"{n}.csv"), "w", encoding="utf-8-sig" if n else "utf-8", newline="") as fh:
            fh.write(text.getvalue() + ("\n" if n == 0 else ""))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in "kab"])
        got = read_csv(spark, d, schema)
        records = csv_records(spark, d)
        assert records.count() == 78 and records.where("is_first").count() == 3
        if split == 64:
            lines = spark.read.option("lineSep", "\n").text(os.path.join(d, "0.csv"))
            assert lines.rdd.getNumPartitions() > 10
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_csv_headers(spark):
    from pyspark.sql import types as T

    d = tempfile.mkdtemp(prefix="mktlens-head-")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    with open(os.path.join(d, "1.csv"), "w") as fh:
        fh.write("b,other,a\nx,?,1\n")
    assert [tuple(r) for r in read_csv(spark, d, schema).collect()] == [(1, "x")]
    with open(os.path.join(d, "2.csv"), "w") as fh:
        fh.write("a,c\n1,2\n")
    with pytest.raises(ValueError, match="lacks the columns b"):
        read_csv(spark, d, schema)
    empty = tempfile.mkdtemp(prefix="mktlens-head-")
    open(os.path.join(empty, "1.csv"), "w").close()
    assert read_csv(spark, empty, schema).count() == 0
