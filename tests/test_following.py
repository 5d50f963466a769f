import random

from mktlens.operators import totals_from


def test_totals_match_pairs(spark):
    rng = random.Random(4)
    daily = {(rng.choice("abc"), rng.randint(1, 30)): rng.randint(-5, 9) for _ in range(50)}
    points = [(i, rng.choice(["a", "b", "c", "d", None]), rng.choice([*range(0, 33), None])) for i in range(120)]
    points += points[:5]
    d = spark.createDataFrame([(k, t, v) for (k, t), v in daily.items()] + [(None, 3, 1), ("a", None, 1)], "k string, t int, v long")
    p = spark.createDataFrame(points, "id int, k string, at int")
    got = sorted(map(tuple, totals_from(p, d, "k", "at", "t", ["v"]).collect()), key=str)
    want = []
    for i, k, at in points:
        own = [(t, v) for (key, t), v in daily.items() if key == k]
        after = [(t, v) for t, v in own if at is not None and t >= at]
        want.append(
            (
                i,
                k,
                at,
                sum(v for _, v in after) if after else None,
                min(t for t, _ in after) if after else None,
                min(t for t, _ in own) if own else None,
            )
        )
    assert got == sorted(want, key=str)


def test_totals_of_nothing(spark):
    d = spark.createDataFrame([], "k string, t int, v long")
    p = spark.createDataFrame([(1, "a", 2)], "id int, k string, at int")
    assert [tuple(r) for r in totals_from(p, d, "k", "at", "t", ["v"]).collect()] == [(1, "a", 2, None, None, None)]
    assert totals_from(p.where("id > 1"), d, "k", "at", "t", ["v"]).count() == 0
