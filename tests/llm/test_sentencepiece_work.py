"""Work that the sampler does for a text, counted."""

import numpy as np

from mktlens.llm import sentencepiece_lattice as S

TEXTS = ["some words of it, and more\nof them " * 20, "Straße 日本 ▁ 12", "x" * 40]


class Counted(np.ndarray):
    """An array that counts the elements looked up in it."""

    def __getitem__(self, at):
        found = super().__getitem__(at)
        Counted.n += np.size(found)
        return found


def test_weights_are_looked_up_for_pieces_only(monkeypatch):
    vocab = S.pieces(S.MODEL)
    chunks = sorted({c for t in TEXTS for c in S.chunks_of(t)})
    want = S.Lattices(vocab, chunks)
    monkeypatch.setattr(vocab, "weight", vocab.weight.view(Counted))
    Counted.n = 0
    got = S.Lattices(vocab, chunks)
    assert (got.piece == want.piece).all() and (np.asarray(got.prob) == np.asarray(want.prob)).all()
    assert 0 < Counted.n <= (got.piece >= 0).sum()


def test_paths_are_cut_for_searched_nodes_only(monkeypatch):
    cut, path = [], S._Drawn.path
    monkeypatch.setattr(S._Drawn, "path", lambda self, i: cut.append(i) or path(self, i))
    samples = S.sample_block(S.pieces(S.MODEL), TEXTS, [1, 2, 3], 2)
    assert [len(s) for s in samples] == [2, 2, 2]
    assert len(cut) == 2 * len(TEXTS)  # of the node searched, and of the choice made there


def test_decoding_does_not_depend_on_its_pieces_at_a_time(monkeypatch):
    vocab = S.pieces(S.MODEL)
    drawn = [(t, S.edge_ids(vocab, s[0][0])) for t, s in zip(TEXTS, S.sample_block(vocab, TEXTS, [1, 2, 3], 1))]
    monkeypatch.setattr(S, "DECODED", 3)
    assert all(vocab.decode(ids) == t for t, ids in drawn) and vocab.decode([]) == ""
