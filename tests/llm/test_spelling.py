import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import EDGES, edges, sf_docs, table  # noqa: F401

from mktlens.llm import spelling as S

UPPER = {c: c + 32 for c in range(65, 91)}


def counts(rows, drop_every):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if drop_every and h % drop_every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            total[word] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def is_near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(rows, drop_every=97):
    words = counts(rows, drop_every)
    near = {w: [x for x in words if abs(len(w) - len(x)) < 2 and is_near(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


TEXTS = (
    ["colour"] * 40 + ["color"] * 18 + ["colours"] * 7 + ["colourz"] * 3 + ["kolours"] * 3 + ["coloour"] * 4 + ["colur"] * 5
    + ["ÀÉÎÕÜ×÷ÿ"] * 3 + ["àÉÎÕÜ×÷ÿ"] * 9 + ["aaaaa aaaaaa aaaaaaa"] * 3 + ["abcde"] * 4 + ["abcdf"] * 8 + ["abcdg"] * 8
    + ["Abcde-ABCDE_abcde1abcde"] + ["tie so that x wxyz short"] * 5
)
ROWS = EDGES + list(enumerate(TEXTS, 100)) + [(100, TEXTS[0])] * 3


@pytest.mark.parametrize("drop_every", [97, None, 3])
def test_matches_brute_force(table, drop_every):
    got = rows_of(S.spelling_variants(table(ROWS), drop_every=drop_every))
    assert got == brute(ROWS, drop_every) and len(got) > 5


@pytest.mark.parametrize("most_blocks", [S.MOST_BLOCKS, 7])
def test_matches_brute_force_on_the_test_table(sf_docs, most_blocks):
    rows = [(r["doc_id"], r["text"]) for r in sf_docs.select("doc_id", "text").limit(90).collect()]
    part = sf_docs.where(sf_docs["doc_id"].isin([i for i, _ in rows]))
    got = rows_of(S.spelling_variants(part, drop_every=97, most_blocks=most_blocks))
    assert got == brute(rows) and any(r[1] for r in got)


def test_a_long_chain_of_forms(table):
    words = ["q" * 6 + "abcdefghij"[:k] for k in range(11)]
    rows = list(enumerate(" ".join([w] * (3 << k)) for k, w in enumerate(words)))
    got = {r[0]: r for r in rows_of(S.spelling_variants(table(rows)))}
    assert got[words[0]][1:3] == (words[1], words[10]) and all(got[w][2] == words[10] for w in words)


def test_long_words_and_frequent_words(table):
    long = "xyz" * 9_000
    rows = [(i, t) for i, t in enumerate([long, long + "a", "b" + long] * 3 + ["common words " * 50_000])]
    got = {r[0]: r for r in rows_of(S.spelling_variants(table(rows)))}
    assert got[long][4] == 2 and got[long + "a"][4] == 1 and got["common"][3] == 50_000


def test_edits_have_the_hashes_of_the_edited_words():
    letters = np.frombuffer("abbcdñabbcdé".encode("latin-1"), dtype=np.uint8).reshape(2, 6)
    filters = S.Filters({5: 1, 6: 1})
    met = []
    for size, row, place, letter, hashes in S._edits(letters, S._hash(letters), filters):
        for r, p, c, h in zip(row, place, letter, hashes, strict=True):
            word = bytes(letters[r])
            new = word[:p] + (bytes([c]) if c else b"") + word[p + 1 :]
            assert len(new) == size and S._hash(np.frombuffer(new, dtype=np.uint8).reshape(1, -1))[0] == h
            met.append((r, new))
    assert len(met) == len(set(met))


def test_filters_are_bounded_and_hold_every_word(sf_docs):
    vocab = S.vocabulary(sf_docs)
    words = vocab.collect()
    for most in (S.MOST_BLOCKS, 5):
        filters, bits = S.build_filters(vocab, most)
        assert len(bits) <= most + S.LAST_SHARD
        for r in words:
            slot, want = filters.slots(r["size"], np.array([r["hash"]], dtype=np.int64).view(np.uint64))
            assert bits[slot[0]] & want[0] == want[0]


def test_empty_table_and_clashing_columns(edges):
    assert S.spelling_variants(edges.where("false")).count() == 0
    named = edges.selectExpr("doc_id as word", "text as n", "n_chars as form")
    assert rows_of(S.spelling_variants(named, id_col="word", text_col="n", drop_every=97)) == brute(EDGES)
