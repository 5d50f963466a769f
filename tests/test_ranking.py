import random

import pytest

from mktlens.operators import rank_desc, rank_desc_window


@pytest.mark.parametrize("keys", [[], ["g"]])
def test_rank_matches_window(spark, keys):
    rnd = random.Random(7)
    rows = []
    for i in range(600):
        v = None if rnd.random() < 0.05 else rnd.choice([rnd.randint(0, 40), 7, 7, 7])
        rows.append((i, rnd.choice(["a", "b", "c"]), v))
    df = spark.createDataFrame(rows, "id int, g string, v int")
    got = {r.id: r.rk for r in rank_desc(df, "v", "rk", keys, buckets=8).collect()}
    exp = {r.id: r.rk for r in rank_desc_window(df, "v", "rk", keys).collect()}
    assert got == exp


def test_rank_all_null_and_single(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, v int")
    assert sorted(r.rk for r in rank_desc(df, "v", "rk").collect()) == [1, 1]
    df = spark.createDataFrame([(1, 5)], "id int, v int")
    assert [r.rk for r in rank_desc(df, "v", "rk").collect()] == [1]


def test_rollup_matches_windows(spark):
    from mktlens.operators import attach_ranks, rank_rollup

    rnd = random.Random(3)
    rows = [(i, rnd.choice(["a", "b", "b", "b", None]), rnd.choice([None, 7, 7, 7, *range(30)])) for i in range(900)]
    for some in (rows, rows[:1], [(1, None, None), (2, None, None)], []):
        df = spark.createDataFrame(some, "id int, g string, v int")
        got = attach_ranks(df, [(rank_rollup(df, "v", "r", "q", ["g"], buckets=8), "v", ["g"])])
        want = rank_desc_window(rank_desc_window(df, "v", "r"), "v", "q", ["g"])
        key = lambda r: r.id
        assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)


def test_activation_ranks_join_twice(spark):
    """Two rank tables and two joins back: one count table by origin and value,
    one by order count, and no sort of all rows in one task."""
    import re

    from mktlens.plans.warehouse import Warehouse

    df = Warehouse.at(spark, "/root/testdata/sf0.001").seller_activation_performance
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    joined = re.findall(r"Join Inner, .*_rk\d_\d", plan)
    assert len(joined) == 2
