import random
import zlib

import numpy as np
import pytest
from llm_fixtures import EDGES, table  # noqa: F401

from mktlens.llm import licenses, ordinal, sampling, toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labelled(spark):
    """Some documents of the middle test table that have labels."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    both = docs.join(labels, "doc_id").select("doc_id", "text", "quality", "toxic").where("length(text) < 8000").toPandas()
    return both.sort_values("doc_id")


def held(ids):
    return np.array([zlib.crc32(str(i).encode()) % 3 == 1 for i in ids])


def test_toxicity_on_held_out_texts(labelled):
    out = held(labelled.doc_id)
    fit, test = labelled[~out], labelled[out].head(900)
    model = toxicity.train(list(zip(fit.text, fit.toxic)), [int((fit.toxic == 0).sum()), int((fit.toxic == 1).sum())])
    of = model.scorer()
    p = np.array([of(t) for t in test.text])
    y = test.toxic.to_numpy() == 1
    order = (p[y][:, None] > p[~y][None, :]).mean()
    assert order > 0.9
    assert (p[~y] >= toxicity.THRESHOLD).mean() < 0.02
    assert p.min() >= 0 and p.max() <= 1


def test_misspellings_share_ngrams():
    rng = random.Random(2)
    syllables = "ka lo mi ne ru ta vo si de pa".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(3))
    clean = [" ".join(word() for _ in range(40)) for _ in range(120)]
    toxic = [" ".join([word() for _ in range(36)] + ["horrible", "nasty"]) for _ in range(80)]
    model = toxicity.train([(t, 0) for t in clean] + [(t, 1) for t in toxic], [120, 80])
    seen = [model.word(w) for w in syllables]
    for unseen in ("horribble", "horible", "nastty"):
        assert model.word(unseen) > max(0, max(seen) / 2)


def test_kept_bucket_vectors_were_trained(monkeypatch):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 5))
    sample = [(" ".join(word() for _ in range(20)) + (" awful" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(120)]
    model = toxicity.train(sample, [90, 30])
    assert 1 <= model.passes <= toxicity.EPOCHS
    monkeypatch.setattr(toxicity, "RATES", (0.0, *toxicity.RATES[1:]))
    unmoved = toxicity.train(sample, [90, 30])
    shape = lambda m: m.weights / np.linalg.norm(m.weights)
    assert np.abs(shape(model) - shape(unmoved)).max() > 1e-4


def test_toxicity_query_and_edges(spark, table):
    rows = EDGES + [(i, f"calm words number {i} here") for i in range(20, 80)]
    rows += [(i, f"horrible nasty words number {i}") for i in range(80, 120)]
    labels = spark.createDataFrame(
        [(i, int(i >= 80)) for i in range(20, 120)] + [(None, 1), (6, None), (2, 7), (99_999, 1), (21, 0)],
        "doc_id long, toxic int",
    )
    got = toxicity.toxicity(table(rows), labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and held([r["doc_id"]])[0])
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    score = {r["doc_id"]: r["score"] for r in got if r["doc_id"] is not None}
    assert np.mean([score[i] for i in range(80, 120)]) > np.mean([score[i] for i in range(20, 80)]) + 0.3
    none = toxicity.toxicity(table(rows), labels.where("false"))
    assert {r["predicted"] for r in none.collect()} == {0}
    assert toxicity.toxicity(table(rows).where("false"), labels).count() == 0


def test_held_out_labels_change_nothing(spark, table):
    rows = [(i, f"{'nasty' if i % 2 else 'calm'} words number {i}") for i in range(60)]
    labels = [(i, i % 2) for i in range(60)]
    flipped = [(i, 1 - y if held([i])[0] else y) for i, y in labels]
    runs = []
    for pairs in (labels, flipped):
        df = spark.createDataFrame(pairs, "doc_id long, toxic int")
        runs.append(sorted((r["doc_id"], r["score"]) for r in toxicity.toxicity(table(rows), df).collect()))
    assert runs[0] == runs[1]


def test_sample_is_bounded_and_by_grade(spark, table):
    from pyspark.sql import functions as F

    rows = [(i, "x" * (i % 50)) for i in range(200)] + [(7, "y")]
    labels = spark.createDataFrame([(i, i % 3) for i in range(200)], "doc_id long, g int")
    sample, counts = sampling.labelled_sample(table(rows), labels, F.col("g"), (5, 9, 1), 40)
    assert counts == [67, 67, 66]
    assert len(sample) <= 15 and all(len(t) <= 40 for t, _ in sample)
    assert sampling.labelled_sample(table(rows), labels, F.col("g"), (5, 9, 1), 40) == (sample, counts)


def test_grades_on_held_out_texts(labelled):
    grade = np.where(labelled.quality == 0, 0, np.where(labelled.toxic == 1, 1, 2))
    out = held(labelled.doc_id)
    fit = list(zip(labelled.text[~out], grade[~out]))
    model = ordinal.train(fit, np.bincount(grade[~out], minlength=3).tolist())
    assert (np.diff(model.thresholds) > 0).all()
    of = model.scorer()
    tails = np.array([of(t) for t in labelled.text[out].head(900)])
    truth = grade[out][:900]
    assert (tails[:, 0] >= tails[:, 1]).all()
    kept = tails[:, 0] >= ordinal.SELECT
    assert kept[truth == 2].mean() > 0.99 and kept[truth == 0].mean() < 0.06


def test_grade_query_and_edges(spark, table):
    rows = EDGES + [(i, f"good words of the number {i}") for i in range(20, 60)]
    rows += [(i, f"W{i}!!! W{i}!!! ### $$$ X{i}!!!") for i in range(60, 100)]
    labels = spark.createDataFrame(
        [(i, int(i < 60), 0) for i in range(20, 100)] + [(None, 1, 1), (2, None, 1), (4, 5, 0)],
        "doc_id long, quality int, toxic int",
    )
    got = ordinal.quality_grades(table(rows), labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["tail_probability"] <= 1 and 0 <= r["expected_grade"] <= 2
        assert r["kept"] == (r["tail_probability"] >= ordinal.SELECT)
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert all(kept[i] == (i < 60) for i in range(20, 100))
    none = ordinal.quality_grades(table(rows), labels.where("false")).collect()
    assert all(r["kept"] for r in none)
    assert ordinal.quality_grades(table(rows).where("false"), labels).count() == 0


def test_licences_of_templates_and_edges(table):
    rows = list(EDGES)
    want = {}
    for family, texts in licenses.TEMPLATES.items():
        for t in texts:
            want[len(rows) + 100] = (family, t)
            rows.append((len(rows) + 100, f"é Some first line.\n  {t}\nThe end of the text."))
    rows.append((900, "You may license this version of the work under the rights of the public."))
    rows.append((901, ("calm words about the weather of the day. " * 30) + "Released under the MIT License. " + "more words. " * 60))
    got = {r["doc_id"]: r for r in licenses.scan_licenses(table(rows)).collect()}
    text = dict(rows)
    for i, (family, t) in want.items():
        assert [f["family"] for f in got[i]["finds"]] == [family], t
        f = got[i]["finds"][0]
        assert text[i][f["start"] : f["end"]] == t and got[i]["n_paragraphs"] == 3
    assert got[900]["finds"] == [] and got[8]["finds"] == [] and got[1]["n_paragraphs"] == 0
    assert [f["family"] for f in got[901]["finds"]] in (["mit"], [])
    assert licenses.scan_licenses(table(rows).where("false")).count() == 0


def test_licences_inside_long_lines(table):
    calm, more = "calm words about the weather of the day. " * 30, "more words. " * 60
    endless = "calm words about the weather and the sea " * 30
    mit, apache = "Released under the MIT License", "the Apache License, Version 2.0"
    bsd = licenses.TEMPLATES["bsd"][2]
    cases = [
        (f"{calm}{mit}. {more}", [("mit", mit)]),
        (f"{endless}{mit} {endless}", [("mit", mit)]),
        (f"Licensed under the MIT License or {apache}, at your option.", [("mit", None), ("apache", apache)]),
        (f"{calm}{mit}. {more}{bsd} {calm}", [("mit", mit), ("bsd", bsd[:-1])]),
        (f"{calm}Under the terms of the report, all of the work was released in the public hall. {more}", []),
    ]
    isc = "Released under the ISC License."
    for family, texts in licenses.TEMPLATES.items():
        for t in texts:
            cases.append((f"{endless}{t} {endless}", [(family, None)]))
            if family != "isc":
                cases.append((f"{calm}{isc} {t} {more}", [("isc", None), (family, None)]))
    got = {r["doc_id"]: r["finds"] for r in licenses.scan_licenses(table([(i, t) for i, (t, _) in enumerate(cases)])).collect()}
    for i, (text, want) in enumerate(cases):
        # A notice that reaches over a cut is found on either side.
        assert list(dict.fromkeys(f["family"] for f in got[i])) == [family for family, _ in want], text
        for family, notice in want:
            assert notice is None or any(notice in text[f["start"] : f["end"]] for f in got[i] if f["family"] == family)


def test_licence_paragraphs_cover_a_text():
    text = " a b.\n\n" + "Some words of it. " * 50 + "\nend"
    parts = list(licenses.paragraphs(text))
    assert all(text[a:b] == p and p == p.strip() for a, b, p in parts)
    assert "".join("".join(p.split()) for _, _, p in parts) == "".join(text.split())
