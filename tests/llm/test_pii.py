import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import EDGES, edges, sf_docs, table  # noqa: F401

from mktlens.llm import pii as P

# The fixed patterns, as plain as they can be said.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def sound(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and sound(digits(m))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(found)


CARD_NO = "4111 1111 1111 1111"
CASES = [
    "a@b.c a@b @b.c a@@b.c a.b+c%d-e_f@x-y.z1.museum. x@y.z_d@e.f",
    "é1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.000000255 1..2.3.4 1.2.3",
    f"{CARD_NO} {CARD_NO.replace(' ', '-')} 4111111111111112 4111  1111 1111 1111 {'4' * 20}",
    "+1 (743) 555-3824, +49.30.123456-7 +1234 + 12345678901 +12345678901234567 +1 (2) 3 ... 4567890123)",
    "+1+2+3 +12 345 678 901+12 345 678 901 日本+81 3 1234 5678😀",
    f"{CARD_NO}@host.example.org 10.0.0.1@x.y",
]
ROWS = EDGES + list(enumerate(CASES, 100)) + [(100, CASES[0])] * 2


@pytest.fixture(scope="module")
def words():
    return ["some plain words of a text that say nothing", "other words, of another text. And more"]


@pytest.fixture(scope="module")
def model(words):
    return P.fit(P.examples(words, 1500), epochs=8)


@pytest.mark.parametrize("text", [t for _, t in ROWS if t and len(t) < 1000])
def test_base_finds_match_the_patterns(text):
    assert P.base_finds(text) == base(text)


@settings(max_examples=600, deadline=None)
@given(st.text(st.sampled_from("0123456789.+-()@ ab_é"), max_size=60))
def test_base_finds_match_the_patterns_on_any_text(text):
    assert P.base_finds(text) == base(text)


def segmentations(r, ending, follow):
    """Every segmentation of a region with its score."""

    def grow(at, label, score, used):
        if at == len(r.places) - 1:
            yield score, tuple(used)
            return
        for j in range(at + 1, len(r.places)):
            for i, k, s in ending[j]:
                if i == at:
                    yield from grow(j, k, score + follow[label][k] + s, [*used, (i, j, k)])

    return list(grow(0, P.NONE, 0.0, []))


SMALL = ["12.34.56.78", "+1 23 4567", "a.b@c.d", "x (at) y dot z", "1234-567 8901-23", "ab at c.d"]


@pytest.mark.parametrize("text", SMALL)
@pytest.mark.parametrize("seed", range(3))
def test_decoding_matches_enumeration(text, seed):
    rng = np.random.default_rng(seed)
    ((a, b),) = P.regions(text)[:1]
    r = P.segments(text, a, b)
    names = {f for *_, feats in r.segments for f in feats}
    m = P.SemiCrf({f: tuple(rng.normal(size=4)) for f in sorted(names)}, rng.normal(size=(5, 5)))
    ending = m.scored(r)
    every = segmentations(r, ending, m.follow)
    top = max(every)
    assert len(every) > 1 and tuple(m.best(ending)) == tuple(s for s in top[1] if s[2] != P.NONE)
    whole = math.log(sum(math.exp(s) for s, _ in every))
    assert m.sums(ending)[2] == pytest.approx(whole)
    want, got = Counter(), Counter()
    for s, used in every:
        for x in used:
            want[x] += math.exp(s - whole)
    for i, j, _, k, q in m.marginals(ending):
        got[i, j, k] += q
    assert {k: pytest.approx(v) for k, v in want.items()} == dict(got)


@pytest.mark.parametrize("text, gold", [("12.34.56.78", (0, 11, 1)), ("x (at) y dot z", (0, 14, 0))])
def test_gradient_matches_differences(text, gold):
    ((a, b),) = P.regions(text)
    r = P.segments(text, a, b)
    at = {p: i for i, p in enumerate(r.places)}
    spans = [(at[gold[0]], at[gold[1]], gold[2])]
    names = {f: i for i, f in enumerate(sorted({f for *_, feats in r.segments for f in feats}))}
    ids = [np.array([names[f] for f in feats]) for *_, feats in r.segments]
    rng = np.random.default_rng(1)
    w, follow = rng.normal(size=(len(names), 4)), rng.normal(size=(5, 5))

    def likelihood(w, follow):
        m = P.SemiCrf({f: tuple(w[i]) for f, i in names.items()}, follow)
        ending = m.scored(r)
        every = segmentations(r, ending, follow)
        right = [s for s, used in every if [x for x in used if x[2] != P.NONE] == spans]
        return right[0] - math.log(sum(math.exp(s) for s, _ in every))

    g_w, g_f = np.zeros_like(w), np.zeros_like(follow)
    P._gradient(P.SemiCrf({}, follow), r, spans, ids, w, g_w, g_f)
    for x, g in ((w, g_w), (follow, g_f)):
        for place in random.Random(2).sample(list(itertools.product(*map(range, x.shape))), 15):
            step = np.zeros_like(x)
            step[place] = 1e-5
            up, down = ((w + s, follow) if x is w else (w, follow + s) for s in (step, -step))
            assert (likelihood(*up) - likelihood(*down)) / 2e-5 == pytest.approx(g[place], abs=1e-5)


def test_held_out_accuracy(model, words):
    right = wrong = missed = 0
    for text, gold in P.examples(words, 1500, seed=77):
        got = {(s, e, k) for a, b in P.regions(text) for s, e, k, p in model.decode(text, a, b) if p >= P.SURE}
        right, wrong, missed = right + len(got & set(gold)), wrong + len(got - set(gold)), missed + len(set(gold) - got)
    assert right / (right + wrong) > 0.98 and right / (right + missed) > 0.92


def added(text, model):
    return [(text[a:b], P.KINDS[k]) for a, k, b, own, _ in P.all_finds(text, model) if not own]


def test_other_spellings_are_added_and_lookalikes_are_not(model):
    card = "5500.0000.0000.0004"
    assert added(f"write to jo.do (at) mail dot example dot com or phone (743) 555-3824 now, card {card}.", model) == [
        ("jo.do (at) mail dot example dot com", "email"),
        ("(743) 555-3824", "phone"),
        (card, "card"),
    ]
    assert added("host 10[.]0[.]20[.]7 is down", model) == [("10[.]0[.]20[.]7", "ip")]
    clean = "On 2023-10-05 at noon, version 1.2.3 of 12 345 units (see 1999-2004, 3.14159) sold at 5.00, that is all; 978-3-16-148410-0"
    assert not P.all_finds(clean, model)


def test_base_finds_stay_and_nothing_overlaps_them(sf_docs, model):
    for r in P.find_pii(sf_docs, model=model).join(sf_docs.select("doc_id", "text"), "doc_id").collect():
        own = [(f["start"], f["rank"], f["end"]) for f in r["finds"] if f["base"]]
        assert own == base(r["text"])
        for f in r["finds"]:
            assert f["base"] or not any(a < f["end"] and f["start"] < b for a, _, b in own)
            assert f["kind"] == P.KINDS[f["rank"]]


def test_long_texts_are_decoded_piece_by_piece(model, monkeypatch):
    numbers = "1 2 ".join(f"{i % 900 + 100} 4{i % 7} 5500-0000-0000-0004 " for i in range(700))
    assert len(P.regions(numbers)) == 1
    monkeypatch.setattr(P, "SURE", 0.0)
    whole = list(model.decode(numbers, 0, len(numbers)))
    monkeypatch.setattr(P, "WINDOW", 10**9)
    at_once = list(model.decode(numbers, 0, len(numbers)))
    assert [x[:3] for x in at_once] == [x[:3] for x in whole] and len(whole) >= 100
    assert [x[3] for x in at_once] == pytest.approx([x[3] for x in whole])
    monkeypatch.undo()
    for text in ("1" * 300_000, "1 " * 60_000, "a@" * 100_000, "+1" * 100_000, "ab." * 50_000 + "@x.y", "1.2.3." * 30_000):
        assert [f[:3] for f in P.all_finds(text, model) if f[3]] == P.base_finds(text)


def test_rows_redaction_and_clashing_columns(table, model):
    df = table(ROWS, extra=("finds", "start", "base", "kind"))
    got = P.find_pii(df, model=model).collect()
    key = lambda x: str(x[0])
    assert sorted([(r["doc_id"], [(f["start"], f["rank"], f["end"]) for f in r["finds"] if f["base"]]) for r in got], key=str) == sorted(
        [(i, base(t)) for i, t in ROWS], key=str
    )
    out = P.redact_pii(df, model=model)
    assert out.columns == df.columns and out.count() == len(ROWS)
    texts = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=key)
    assert [t for i, t in texts if i == 105] == ["[CARD] [EMAIL]"] and [t for i, t in texts if i == 4] == ["word"]
    assert P.redacted("a b c", []) == "a b c" and P.redacted(None, []) is None


def test_training_on_the_table_itself(sf_docs):
    found = P.find_pii(sf_docs)
    assert found.count() == sf_docs.count()
    again = P.train(sf_docs.repartition(7))
    assert again.weights == P.train(sf_docs.orderBy("n_chars")).weights


def test_empty_table(edges, model):
    none = edges.where("false")
    assert P.find_pii(none).count() == 0 and P.redact_pii(none, model=model).columns == none.columns
