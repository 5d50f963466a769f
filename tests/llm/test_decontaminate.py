import random
import re

import pytest
from llm_fixtures import EDGES, edges, sf_docs, table  # noqa: F401

from mktlens.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, window=10):
    grams = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if n else []:
            grams.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    out = []
    for i, text in rows:
        w = words(text)
        hit, found = set(), set()
        for n in {len(g) for g in grams}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in grams:
                    hit |= set(range(j, j + n))
                    found |= grams[tuple(w[j : j + n])]
        out.append((i, len(w), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=str)


def got(docs, bench):
    rows = D.contamination(docs, bench).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in rows), key=str)


@pytest.fixture
def bench(spark):
    def make(items):
        return spark.createDataFrame([(i, t, "?", "?") for i, t in items], "item_id long, text string, words string, hash string")

    return make


rng = random.Random(5)
VOCAB = "red green blue one two three É été 日本 9 x1 the of".split()
PROSE = lambda n: " ".join(rng.choice(VOCAB) for _ in range(n))
ITEMS = [(i, PROSE(rng.randint(10, 25))) for i in range(8)]
ITEMS += [(8, "Alpha, BETA; gamma!"), (9, "solo"), (10, None), (11, "  .,;"), (None, PROSE(12)), (3, PROSE(11))]
DOCS = EDGES + [(20 + i, f"{PROSE(8)} {ITEMS[i % 8][1].upper()}, {PROSE(6)}") for i in range(12)]
DOCS += [(50, "alpha-beta gamma alpha beta gamma"), (51, "Solo? solo"), (52, ITEMS[0][1] + " " + ITEMS[0][1]), (53, PROSE(9))]


@pytest.mark.parametrize("small", [True, False])
def test_matches_brute_force(table, bench, monkeypatch, small):
    if not small:  # slices of five hashes, and the shuffled join beyond the broadcast's bound
        monkeypatch.setattr(D, "SET_BYTES", 5 * D.HASH_BYTES)
        monkeypatch.setattr(D, "BROADCAST_BYTES", 0)
    assert got(table(DOCS), bench(ITEMS)) == brute(DOCS, ITEMS)


def test_matches_brute_force_on_the_test_table(spark, sf_docs):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in sf_docs.select("doc_id", "text").collect()]
    assert got(sf_docs, items) == brute(rows, [tuple(r) for r in items.select("item_id", "text").collect()])


def test_documents_and_spans_are_removed(table, bench):
    docs, items = table(DOCS), bench(ITEMS)
    clean = sorted(((i, t) for (i, t) in DOCS if not brute([(i, t)], ITEMS)[0][4]), key=str)
    left = D.remove_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == clean
    cut = D.remove_contaminated(docs, items, mode="spans")
    assert cut.columns == docs.columns
    after = sorted(((r["doc_id"], r["text"]) for r in cut.collect()), key=str)
    assert len(after) == len(DOCS) and set(clean) <= set(after)
    texts = dict((i, t) for i, t in after if i is not None and i >= 20)
    for i, t in DOCS:
        if i is not None and i >= 20:
            w = words(t)
            n_hit = brute([(i, t)], ITEMS)[0][2]
            assert len(words(texts[i])) == len(w) - n_hit, (t, texts[i])


def test_windows_of_documents_stay_where_they_are_read(table, bench, capsys):
    D.find_hits(table(DOCS), bench(ITEMS)).explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("BroadcastExchange") and "Generate" in plan
    assert not any(x in plan for x in ("SortMergeJoin", "hashpartitioning", "ArrowEval", "BatchEval", "MapIn"))


def test_spans_cut_from_a_long_text_that_is_hit_all_over(table, bench):
    item = ITEMS[0][1]
    text = f"({item}; keep) " * 800
    (row,) = D.remove_contaminated(table([(1, text)]), bench(ITEMS[:1]), mode="spans").collect()
    assert words(row["text"]) == ["keep"] * 800


def test_empty_tables(edges, bench):
    assert got(edges.where("false"), bench(ITEMS)) == []
    assert all(not r[4] for r in got(edges, bench([])))
