import zlib

import pytest
from llm_fixtures import EDGES, edges, sf_docs, table  # noqa: F401

from mktlens.llm import shards as S


def placed(df, n=16):
    return [r.asDict() for r in S.shard(df, n).collect()]


def check(rows, got, n=16):
    size = lambda t: len((t or "").encode()) + 1
    want = sorted(((i, size(t), zlib.crc32((t or "").encode())) for i, t in rows), key=str)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=str) == want
    total, most = sum(s for _, s, _ in want), max(s for _, s, _ in want)
    load = [0] * n
    slots = [[] for _ in range(n)]
    for r in got:
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    for s in slots:
        assert sorted(s) == list(range(len(s)))
    # A record straddles a border by its half, a whole group by its share.
    slack = most + S.SPLIT_SHARE * total / n + 1
    assert all(abs(x - total / n) <= slack for x in load), load


def test_edges_and_clashing_columns(edges):
    check(EDGES, placed(edges))


def test_matches_definition_on_the_test_table(sf_docs):
    rows = [(r["doc_id"], r["text"]) for r in sf_docs.select("doc_id", "text").collect()]
    got = placed(sf_docs)
    check(rows, got)
    assert {r["shard"] for r in got} == set(range(16))


@pytest.mark.parametrize("hot", [0, 700])
def test_hot_group_is_subdivided(table, hot):
    rows = [(i, f"text {i % 400} " * (1 + i % 9)) for i in range(1300)] + [(5000 + i, "the same text " * 5) for i in range(hot)]
    got = placed(table(rows))
    check(rows, got)
    by_text = {}
    for r in got:
        by_text.setdefault(r["text_crc32"], set()).add(r["shard"])
    split = sum(len(s) > 1 for s in by_text.values())
    assert split <= 1 + 16 * (hot > 0)


def test_same_places_again(table):
    rows = [(i, f"text {i % 300}") for i in range(900)]
    key = lambda r: r["doc_id"]
    first, again = placed(table(rows)), placed(table(rows[::-1]).repartition(7))
    assert sorted(first, key=key) == sorted(again, key=key)


def test_written_shards_hold_every_row_once(edges, spark, tmp_path):
    path = str(tmp_path / "shards")
    S.write_shards(edges, path, 4)
    back = spark.read.parquet(path)
    got = sorted(((r["doc_id"], r["text"]) for r in back.collect()), key=str)
    assert got == sorted(EDGES, key=str)


@pytest.mark.parametrize("text, ids", [(None, True), (None, False), ("", True), ("same", False)])
def test_rows_without_weight_are_subdivided(table, monkeypatch, text, ids):
    seen = []
    kept = S.materialize
    monkeypatch.setattr(S, "materialize", lambda df, label: seen.append((label, kept(df, label))) or seen[-1][1])
    rows = [(i, f"text {i} " * 12) for i in range(4000)] + [(9000 + i if ids else None, text) for i in range(2000)]
    got = placed(table(rows))
    check(rows, got)
    units = dict(seen)["shard-units"].groupBy("unit").count().toPandas()["count"]
    assert units.max() <= 3 * 6000 / S.MIN_RANGES
    key = lambda r: str(sorted(r.items()))
    assert sorted(got, key=key) == sorted(placed(table(rows[::-1]).repartition(7)), key=key)


def test_written_files_follow_the_plan(table, spark, tmp_path):
    rows = [(i, f"text {i % 90} " * 3) for i in range(500)] + [(None, "the same text")] * 700
    df, path = table(rows), str(tmp_path / "shards")
    plan = S.write_shards(df, path, 4)
    back = spark.read.parquet(path)
    assert set(back.columns) == {*df.columns, "shard_"}
    assert {r["shard"] for r in back.select("shard").distinct().collect()} == {"?"}
    count = lambda d, *c: sorted((tuple(r) for r in d.groupBy(*c).count().collect()), key=str)
    assert count(back, "doc_id", "shard_") == count(plan, "doc_id", "shard")
    assert sorted(((r["doc_id"], r["text"]) for r in back.collect()), key=str) == sorted(rows, key=str)


def test_empty_table(edges):
    assert S.shard(edges.where("false")).count() == 0
