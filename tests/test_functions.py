import datetime as dt
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mktlens.functions import clean_text, delay_bucket, delivery_status, pct, rounded_quotient, string_set_agg, trim_ws


def _half_away(n: int, d: int, digits: int) -> float:
    q = Fraction(abs(n) * 10**digits, d)
    r = int(q) + (1 if q - int(q) >= Fraction(1, 2) else 0)
    return (-r if n < 0 else r) / 10**digits


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**6, 10**6), st.integers(0, 5000)), min_size=1, max_size=40))
def test_rounded_quotient_is_exact(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = df.select("n", "d", rounded_quotient("n", "d", 2).alias("r")).collect()
    for row in got:
        expect = None if row.d == 0 else _half_away(row.n, row.d, 2)
        assert row.r == expect, (row.n, row.d, row.r, expect)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(-(10**18), 10**18), st.integers(0, 10**18)), min_size=1, max_size=30))
def test_rounding_does_not_overflow(spark, pairs):
    pairs = [(n, d) for n, d in pairs if not d or abs(n) <= 10**14 * d]
    df = spark.createDataFrame([*pairs, (10**17, 3), (-(10**18), 10**18), (10**16, 10**18)], "n long, d long")
    got = df.select("n", "d", rounded_quotient("n", "d").alias("r"), pct("n", "d").alias("p")).collect()
    for row in got:
        if row.d == 0:
            assert row.r is None and row.p is None
            continue
        for value, times in ((row.r, 1), (row.p, 100)):
            expect = _half_away(row.n * times, row.d, 2)
            # beyond 2^53 hundredths a double has no exact form
            assert value == expect or abs(expect) > 2**46 and abs(value - expect) <= 4e-16 * abs(expect), row


def test_pct_ties_round_half_away(spark):
    df = spark.createDataFrame([(1, 8), (1, 32), (0, 0), (2, 3)], "a long, b long")
    got = [r.p for r in df.select(pct("a", "b").alias("p")).collect()]
    assert got == [12.5, 3.13, None, 66.67]


def test_trim_ws_strips_unicode_white_space(spark):
    df = spark.createDataFrame([("\t Credit_Card  ",), ("  ",), (None,)], "s string")
    got = [r.c for r in df.select(clean_text("s").alias("c")).collect()]
    assert got == ["credit_card", "", None]
    assert df.select(trim_ws(F.lit(" a b ")).alias("t")).first().t == "a b"


def test_delivery_status_and_bucket(spark):
    est = dt.datetime(2020, 1, 10, 12, 0, 0)
    rows = [
        ("at_estimate", est, est),
        ("later_same_day", dt.datetime(2020, 1, 10, 18, 0), est),
        ("late_1", dt.datetime(2020, 1, 11, 1, 0), est),
        ("late_3", dt.datetime(2020, 1, 13), est),
        ("late_4", dt.datetime(2020, 1, 14), est),
        ("late_7", dt.datetime(2020, 1, 17), est),
        ("late_8", dt.datetime(2020, 1, 18), est),
        ("null_estimate", dt.datetime(2020, 1, 1), None),
        ("not_delivered", None, est),
    ]
    df = spark.createDataFrame(rows, "k string, d timestamp_ntz, e timestamp_ntz")
    got = {r.k: (r.s, r.b) for r in df.select("k", delivery_status("d", "e").alias("s"), delay_bucket("d", "e").alias("b")).collect()}
    assert got["at_estimate"] == ("on_time", "on_time_or_early")
    assert got["later_same_day"] == ("late", "on_time_or_early")
    assert got["late_1"] == ("late", "late_1_3_days")
    assert got["late_3"] == ("late", "late_1_3_days")
    assert got["late_4"] == ("late", "late_4_7_days")
    assert got["late_7"] == ("late", "late_4_7_days")
    assert got["late_8"] == ("late", "late_8_plus_days")
    assert got["null_estimate"] == ("late", "late_8_plus_days")
    assert got["not_delivered"] == ("not_delivered", "not_delivered")


def test_string_set_agg(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None)], "k int, v string")
    got = {r.k: r.s for r in df.groupBy("k").agg(string_set_agg("v").alias("s")).collect()}
    assert got == {1: "a, b", 2: None}
