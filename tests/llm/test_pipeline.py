import corpus_pipeline as P
import pytest
import test_decontaminate
import test_quality_rules
import test_secrets
import test_simhash
from llm_fixtures import EDGES, edges, sf_docs, table  # noqa: F401

from mktlens.llm import quality_rules, sentencepiece_lattice
from mktlens.sources.sinks import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages_are_the_stated_ones():
    assert [n for n, _ in P.STAGES] == [
        "quality rules",
        "simhash near-dedup",
        "benchmark decontamination",
        "secret scans",
        "sentencepiece encoding",
    ]


def test_each_stage_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept, out = [], docs
    for name, stage in P.STAGES[:-1]:
        before = rows_of(out)
        out = materialize(stage(spark, out, sf), "test-pipeline")
        assert out.columns == COLUMNS
        after = sorted(rows_of(out))
        if name == "quality rules":
            verdicts = quality_rules.quality_rules(docs).collect()
            want = [(r["doc_id"], r["text"]) for r in verdicts if not r["quality_failed"] and not test_quality_rules.brute(r["text"])[5]]
        elif name == "simhash near-dedup":
            want = [r for r, (i, _, group) in zip(before, test_simhash.brute_groups(before)) if i == group]
        elif name == "benchmark decontamination":
            want = [r for r in before if not test_decontaminate.brute([r], items)[0][4]]
        else:
            assert [i for i, _ in after] == sorted(i for i, _ in before)
            assert all(not test_secrets.base(t) for _, t in after)
            clean = {i for i, t in before if not test_secrets.base(t) and not test_secrets.weak(t)}
            want = [r for r in before if r[0] in clean] + [r for r in after if r[0] not in clean]
        assert after == sorted(want), name
        kept.append(len(after))
    assert kept[0] < docs.count() and kept[1] < kept[0] and kept[2] < kept[1] and kept[3] == kept[2]
    texts = dict(rows_of(out))
    encoded = sentencepiece_lattice.decode(P.run(spark, sf)).collect()
    assert len(encoded) == 2 * len(texts) and all(texts[r["doc_id"]] == r["text"] for r in encoded)


@pytest.mark.parametrize("rows", [EDGES, []])
def test_edges_go_through_every_stage(spark, table, rows):  # noqa: F811
    df = table(rows)
    for _, stage in P.STAGES[:-1]:
        df = stage(spark, df, "/root/testdata/sf0.001")
        assert df.columns == table([]).columns
        df.count()
        # judged on edges themselves, not on what the rules leave of them
        stage(spark, table(rows), "/root/testdata/sf0.001").collect()
    assert P.encode(spark, table(rows), "").where("sample = 0").count() == len(rows)
