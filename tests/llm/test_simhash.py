import random
import re

import pytest
import xxhash
from llm_fixtures import EDGES, edges, sf_docs, table  # noqa: F401

from mktlens.llm import simhash
from mktlens.llm.components import components


def brute_print(text):
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    votes = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for j in range(64):
            votes[j] += h >> j & 1
    return sum(1 << j for j in range(64) if 2 * votes[j] > len(grams))


def roots(values, radius):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    values = sorted(values)
    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def brute_groups(rows, radius=2):
    prints = [brute_print(t) for _, t in rows]
    root = roots(set(prints), radius)
    ids = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            ids[root[p]] = min(i, ids.get(root[p], i))
    return [(i, f"{p:016x}", ids.get(root[p])) for (i, _), p in zip(rows, prints)]


def as_list(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_fingerprint_matches_definition():
    for text in [t for _, t in EDGES[:-2]] + ["A b C d e F", "x " * 70_000]:
        assert simhash.fingerprint(text) == brute_print(text)


def test_every_pair_within_the_radius_shares_a_bucket():
    rng = random.Random(1)
    for radius in (1, 2):
        masks = simhash.masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(2000):
            bits = rng.sample(range(64), radius)
            diff = sum(1 << b for b in bits)
            assert any(diff & m == 0 for m in masks)


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_links_connect_exactly_the_near_fingerprints(spark, radius):
    rng = random.Random(radius)
    values = set()
    for _ in range(30):  # clusters, chains and loners
        v = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            values.add(v)
            for _ in range(rng.randint(1, 3)):
                v ^= 1 << rng.randrange(64)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), radius)
    got = {r["vertex"]: r["root"] for r in components(links).collect()}
    mask = (1 << 64) - 1
    groups = {}
    for (v,) in signed:
        groups.setdefault(got.get(v, v), set()).add(v & mask)
    expected = {}
    for v, r in roots(values, radius).items():
        expected.setdefault(r, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(5, i) for i in range(200, 400)]
    links = spark.createDataFrame(chain + hub + [(7, 7), (None, 3)], "a long, b long")
    got = {r["vertex"]: r["root"] for r in components(links).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in [5, *range(200, 400)]}}
    assert components(links.where("a > 1000")).count() == 0


def test_edges_and_clashing_columns(edges):
    assert as_list(simhash.near_duplicates(edges).collect()) == as_list(brute_groups(EDGES))


def test_matches_brute_force_on_the_test_table(sf_docs):
    rows = [(r["doc_id"], r["text"]) for r in sf_docs.select("doc_id", "text").collect()]
    assert as_list(simhash.near_duplicates(sf_docs).collect()) == as_list(brute_groups(rows))


def test_one_row_of_each_group_stays(edges):
    kept = simhash.drop_near_duplicates(edges)
    assert kept.columns == edges.columns
    groups = brute_groups(EDGES)
    by_group = {}
    for (i, _), (_, print_, group) in zip(EDGES, groups):
        by_group.setdefault(group if group is not None else print_, []).append(i)
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert len(got) == len(by_group)
    for i, t in got:
        group = next(g for (j, u), (_, p, g) in zip(EDGES, groups) if (j, u) == (i, t))
        assert group == i


def test_empty_table(edges):
    none = edges.where("false")
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.drop_near_duplicates(none).count() == 0
