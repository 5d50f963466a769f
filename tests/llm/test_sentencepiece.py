import math
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import EDGES, edges, table  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from mktlens.llm import sentencepiece_lattice as S


@pytest.fixture(scope="module")
def vocab():
    return S.pieces(S.MODEL)


def every_segmentation(vocab, text):
    """{edges: weight} by brute force over the model's pieces."""
    by_text = {}
    for i, b in enumerate(vocab.bytes):
        if b and vocab.log_weight[i]:
            by_text[b.decode()] = i
    out = {}

    def walk(rest, edges, log_weight):
        if not rest:
            out[tuple(edges)] = math.exp(log_weight)
            return
        single = False
        for n in range(1, min(16, len(rest)) + 1):
            i = by_text.get(rest[:n])
            if i is not None:
                single |= n == 1
                walk(rest[n:], [*edges, i], log_weight + vocab.log_weight[i])
        if not single:
            walk(rest[1:], [*edges, -1 - ord(rest[0])], log_weight + vocab.fallback)

    walk(" " + text, [], 0.0)
    return out


@pytest.mark.parametrize("text", ["hello", "the  cat", "a\nb", "é日x", "of it"])
def test_samples_follow_the_lattice(vocab, text):
    weights = every_segmentation(vocab, text)
    total = sum(weights.values())
    p = {e: w / total for e, w in weights.items()}
    n = 4000
    drawn = S.sample_block(vocab, [text] * n, list(range(n)), 2)
    first, either, inverse = Counter(), Counter(), Counter()
    for samples in drawn:
        edges = [tuple(e.tolist()) for e, *_ in samples]
        assert len(set(edges)) == len(edges) == min(2, len(p))
        first[edges[0]] += 1
        for e, (_, log_prob, _, inclusion) in zip(edges, samples):
            assert math.isclose(math.exp(log_prob), p[e], rel_tol=1e-6)
            either[e] += 1
            inverse[e] += 1 / inclusion
        assert all(a[2] > b[2] for a, b in zip(samples, samples[1:]))
    for e, q in sorted(p.items(), key=lambda x: -x[1])[:4]:
        slack = 4 * math.sqrt(q / n) + 1e-3
        assert abs(first[e] / n - q) < slack
        both = q + sum(r * q / (1 - r) for f, r in p.items() if f != e and r < 1)
        assert abs(either[e] / n - both) < 4 * math.sqrt(both / n) + 1e-3
        if q > 0.05:  # inclusion scores give unbiased weights
            assert abs(inverse[e] / n - 1) < 0.25


def test_all_segmentations_come_out_once(vocab):
    text = "cats"
    p = every_segmentation(vocab, text)
    samples = S.sample_block(vocab, [text], [5], 10_000)[0]
    assert {tuple(e.tolist()) for e, *_ in samples} == set(p) and len(samples) == len(p)
    assert all(s[3] == 1.0 for s in samples)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=4), st.integers(1, 3))
def test_round_trip_of_any_text(texts, k):
    vocab = S.pieces(S.MODEL)
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    for t, samples in zip(texts, S.sample_block(vocab, texts, list(range(len(texts))), k)):
        seen = [S.edge_ids(vocab, e).tolist() for e, *_ in samples]
        assert all(vocab.decode(ids) == t for ids in seen)


def test_result_does_not_depend_on_the_batch(vocab, monkeypatch):
    texts = ["some words of it " * 40, "x" * 500, "more\nlines\n" * 30]
    whole = S.sample_block(vocab, texts, [1, 2, 3], 3)
    monkeypatch.setattr(S, "NOTED_CHARS", 2000)
    common = S.Frequent(vocab)
    for _ in range(3):  # counted, then with shared lattices
        for a, b in zip(whole, S.sample_block(vocab, texts, [1, 2, 3], 3, common)):
            assert all((x[0] == y[0]).all() and x[1:] == y[1:] for x, y in zip(a, b))
    assert common.index
    monkeypatch.setattr(S, "BLOCK_CHARS", 40)  # lattices in groups, as for one very long text
    for i, t in enumerate(texts):
        alone = S.sample_block(vocab, [t], [i + 1], 3)[0]
        for a, b in zip(whole[i], alone):
            assert (a[0] == b[0]).all() and np.allclose(a[1:], b[1:], rtol=1e-9)


def test_query_and_edges(edges):
    got = S.encode(edges, k=2)
    back = S.decode(got)
    rows = back.collect()
    assert all(r["round_trip"] for r in rows)
    texts = Counter((r["doc_id"], r["text"]) for r in rows if r["sample"] == 0)
    assert texts == Counter((i, t or "") for i, t in EDGES)
    twice = [r["ids"] for r in rows if (r["doc_id"], r["text"], r["sample"]) == (6, "two words", 1)]
    assert len(twice) == 2 and twice[0] == twice[1]
    again = S.encode(edges.repartition(5), k=2).collect()
    key = lambda r: str((r["doc_id"], r["row_key"], r["sample"], r["ids"][:50]))
    assert sorted(map(key, rows)) == sorted(map(key, again))
    assert S.encode(edges.where("false")).count() == 0


def test_a_long_unbroken_text_takes_memory_in_proportion():
    """Letters and digits without a space: the walk that avoids the first
    sample holds each place once, not each place with the path behind it."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = """
import random, resource, string
from mktlens.llm import sentencepiece_lattice as S
vocab = S.pieces(S.MODEL)
text = "".join(random.Random(3).choices(string.ascii_letters + string.digits, k=120_000))
((one, two),) = S.sample_block(vocab, [text], [1], 2)
ids = [S.edge_ids(vocab, e).tolist() for e, *_ in (one, two)]
assert ids[0] != ids[1] and all(vocab.decode(i) == text for i in ids)
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss)
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=root, check=True, capture_output=True, text=True)
    assert int(out.stdout) < 1 << 20  # KB
