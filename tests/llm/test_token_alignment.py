import hashlib
from bisect import bisect_left
from collections import Counter

import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import EDGES, edges, sf_docs, table  # noqa: F401

from mktlens.llm import token_alignment as A

COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


@pytest.fixture(scope="module")
def plain():
    """Whole texts through the public libraries: (ids, bytes of each) twice."""
    a = tokenizers.Tokenizer.from_file(A.MODEL_A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=A.MODEL_B)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [x for x in range(256) if x not in printable]
    to_byte = {chr(x): x for x in printable} | {chr(256 + i): x for i, x in enumerate(odd)}

    def of(text):
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        bytes_a = [bytes(to_byte[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = []
        for i in ids_b:
            p = b.id_to_piece(i)
            bytes_b.append(bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
        want = (" " + text).encode()
        if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            return [], []
        return [*zip(ids_a, map(len, bytes_a), strict=True)], [*zip(ids_b, map(len, bytes_b), strict=True)]

    return of


def spans(tokens):
    at, out = 0, []
    for i, n in tokens:
        out.append((i, at, at + n))
        at += n
    return out


def owners(tokens):
    """The token of each byte."""
    return [k for k, (_, n) in enumerate(tokens) for _ in range(n)]


def brute(texts, encode):
    """Pairs byte by byte, groups by common ends."""
    rows, links = [], []
    for t in texts:
        tokens = encode(t or "")
        a, b = map(spans, tokens)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        sides = [[[] for _ in cuts] for _ in "ab"]
        for side, tokens_of in zip(sides, (a, b), strict=True):
            for i, _, e in tokens_of:
                side[bisect_left(cuts, e)].append(str(i))
        groups = [",".join(x) + "|" + ",".join(y) for x, y in zip(*sides, strict=True)]
        pairs = set(zip(*map(owners, tokens), strict=True))
        found = Counter((a[x][0], b[y][0]) for x, y in pairs)
        rows.append((len(a), len(b), len(groups), sum(found.values()), ";".join(groups)))
        links.append(found)
    score = Counter(p for found in links for p in found)
    top = Counter()
    for (i, _), n in score.items():
        top[i] = max(top[i], n)
    out = []
    for (n_a, n_b, n_g, n_l, text), found in zip(rows, links, strict=True):
        best = sum(m for p, m in found.items() if score[p] == top[p[0]])
        digest = hashlib.sha256(text.encode()).hexdigest() if n_a else ""
        out.append((n_a, n_b, n_g, n_l, best, sum(m * score[p] for p, m in found.items()), digest))
    return out, score, Counter(p for found in links for p in found.elements()), [r[-1] for r in rows]


CASES = [
    "two  blanks and\ttabs \n \n lines \n",
    "a<|endoftext|>b </s> <unk> <s>",
    "▁ piece mark",
    "no break   wide　",
    "日本語のテキスト and العربية 😀👨‍👩‍👧 é é",
    "\x00 control \x1f\x85 bytes",
    "don't we'll I'M x's 's",
    "12345 67 8.9e10 ... --- ===",
    " leading",
    "trailing ",
    "\nline\n\n\nbreaks\n ",
    "x" * 3000,
    "the the the the",
    "ａｂｃ ﬁ ½ Ⅷ K Å",
]
ROWS = [(i, t) for i, t in EDGES if len(t or "") < 1000] + list(enumerate(CASES, 100)) + [(100, CASES[0])] * 3


def rows_of(df):
    return sorted(((r["doc_id"], *(r[c] for c in COLUMNS), r["groups_sha256"]) for r in df.collect()), key=str)


def test_matches_brute_force(table, plain):
    want, score, links, groups = brute([t for _, t in ROWS], plain)
    df = table(ROWS)
    assert rows_of(A.align(df)) == sorted(((i, *w) for (i, _), w in zip(ROWS, want, strict=True)), key=str)
    got = {(r["a"], r["b"]): (r["docs"], r["links"]) for r in A.pair_scores(df).collect()}
    assert got == {p: (n, links[p]) for p, n in score.items()}
    text = sorted(((r["doc_id"], r["groups"]) for r in A.token_groups(df).collect()), key=str)
    assert text == sorted(((i, g) for (i, _), g in zip(ROWS, groups, strict=True)), key=str)


def test_blocks_change_nothing(sf_docs, plain):
    rows = sf_docs.select("doc_id", "text").collect()
    want = brute([r["text"] for r in rows], plain)[0]
    got = rows_of(A.align(sf_docs.repartition(5)))
    assert got == sorted(((r["doc_id"], *w) for r, w in zip(rows, want, strict=True)), key=str)


def blocks_of(texts, chars, units=10**6):
    """The blocks of one task, made small."""
    tok, blocks = A.load(A.MODEL_A, A.MODEL_B), []
    block = A.Block(A.Units(tok))
    for i, t in enumerate(texts):
        block.add(i, t)
        if block.chars >= chars:
            block.align()
            blocks.append(block)
            block = A.Block(A.Units(tok) if len(block.units.groups) > units else block.units)
    block.align()
    return [*blocks, block]


def test_units_kept_from_block_to_block(sf_docs, plain):
    texts = [r["text"] for r in sf_docs.orderBy("doc_id").collect()][:60]
    want = brute(texts, plain)
    for chars, units in ((1, 10**6), (9_000, 300), (10**9, 1)):
        blocks = blocks_of(texts, chars, units)
        assert [g.decode() for b in blocks for g in b.groups()] == want[3]
        docs, links = Counter(), Counter()
        for b in blocks:
            p = b.pairs()
            for i, j, d, n in zip(p["a"].tolist(), p["b"].tolist(), p["docs"].tolist(), p["links"].tolist(), strict=True):
                docs[i, j] += d
                links[i, j] += n
        assert docs == want[1] and links == want[2]


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t\r\x0b\x85\xa0 ab'sé.1▁"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_units_cut_as_whole_texts(plain, text):
    want = plain(text)
    (block,) = blocks_of([text], 10**9)
    found = block.units
    units = A._units(text, found.tok.cut) if text else []
    assert all(found.good[found.known[u]] for u in units) == (bool(want[0]) or not text)
    if want[0]:
        got = b";".join(found.groups[found.known[u]] for u in units).decode()
        a = [i for g in got.split(";") for i in g.split("|")[0].split(",")]
        b = [i for g in got.split(";") for i in g.split("|")[1].split(",")]
        assert (a, b) == tuple([str(i) for i, _ in side] for side in want)


def test_many_copies_and_a_long_unbroken_text(table, plain):
    texts = ["the same words again"] * 700 + ["aZ9" * 60_000, "x y"]
    df = table(list(enumerate(texts)))
    got = {r["doc_id"]: r for r in A.align(df).collect()}
    assert got[0]["count_sum"] == got[699]["count_sum"] == 700 * got[0]["n_links"] and got[0]["n_best"] == got[0]["n_links"]
    assert got[700]["n_a"] == len(plain(texts[700])[0])


def test_empty_table_and_clashing_columns(edges):
    none = edges.where("false")
    assert A.align(none).count() == 0 and A.token_groups(none).count() == 0 and A.pair_scores(none).count() == 0
    named = edges.selectExpr("doc_id as a", "text as block", "doc_id as text", "n_chars as docs")
    got = A.align(named, id_col="a", text_col="block")
    assert got.columns[0] == "doc_id" and got.count() == edges.count()
