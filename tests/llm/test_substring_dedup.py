import random
import re

from llm_fixtures import EDGES, edges, sf_docs, table  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from mktlens.llm import substring_dedup as S


def brute(rows, window=20):
    """{(id, text): (n_words, n_removed, kept)}; rows that repeat both are one."""
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = set(), {}
    for i, t in order:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())
        gone = [False] * len(words)
        for j in range(len(words) - window + 1):
            w = tuple(words[j : j + window])
            if w in seen:
                gone[j : j + window] = [True] * window
            seen.add(w)
        kept = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        out[i, t] = (len(words), sum(gone), kept)
    return out


def check(df, rows, **kw):
    want = brute(rows, kw.get("window", 20))
    expected = sorted(((i, *want[i, t]) for i, t in rows), key=str)
    assert sorted(map(tuple, S.substring_dedup(df, **kw).collect()), key=str) == expected


def test_edges_and_clashing_columns(edges):
    # Rows 6 repeat an id with another text; their order between themselves is
    # free, but they share no window here.
    check(edges, EDGES)


def test_matches_brute_force_on_the_test_table(sf_docs):
    check(sf_docs, [(r["doc_id"], r["text"]) for r in sf_docs.select("doc_id", "text").collect()])


def test_shared_passages_copies_and_loops(table, monkeypatch):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(50)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passage = text(55)
    rows = [(i, f"{text(rng.randint(0, 40))} {passage} {text(rng.randint(0, 40))}") for i in range(60)]
    rows += [(100 + i, rows[7][1]) for i in range(20)]  # copies of a whole text
    rows += [(200, "la " * 500), (201, "la la li " * 90), (202, "x la " * 30 + passage)]
    check(table(rows), rows)
    check(table(rows), rows, window=7, gram=2)
    monkeypatch.setattr(S, "HOT", 5)  # the passage's bucket is split window by window
    check(table(rows), rows)


def test_large_ids_beside_nulls(table):
    words = " ".join(f"w{i}" for i in range(30))
    rows = [(2**62 + 1, words), (2**62, words), (None, words)]
    check(table(rows), rows)


def test_empty_table(edges):
    assert S.substring_dedup(edges.where("false")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "cc", "é"]), min_size=20, max_size=120))
def test_super_kmers_cover_each_window_once(words):
    raw = [w.encode() for w in words]
    values, starts, sizes, again = S.super_kmers(raw)
    assert starts[0] == 0 and (starts[1:] == starts[:-1] + sizes[:-1]).all()
    assert starts[-1] + sizes[-1] == len(words) - S.WINDOW + 1
    least, _ = S.minimisers(S.word_prints(raw))
    windows = {}
    for i in range(len(least)):  # equal windows have equal minimisers
        assert windows.setdefault(tuple(words[i : i + 20]), least[i]) == least[i]
    for v, s, n, a in zip(values, starts, sizes, again):
        assert (least[s : s + n] == v).all()
        inside = [tuple(words[i : i + 20]) for i in range(s, s + n)]
        assert a or len(set(inside)) == len(inside)
