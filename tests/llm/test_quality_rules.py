import re

from llm_fixtures import EDGES, edges, sf_docs, table  # noqa: F401

from mktlens.llm import quality_rules as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeated = {p for at in seen.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)}
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(repeated),
        n < 50 or 100 * len(repeated) > 50 * n,
    )


CASES = [
    "a b c a b c x a b c",
    "la la la la",
    "a b a b a",
    "one\n\none\n two\none",
    "# * $ % & | < > ##",
    "the end of the day and the end of the day",
    " ".join(f"w{i}" for i in range(60)),
    " ".join(["the quick brown fox and the lazy dog of the house"] * 3 + [f"the w{i} of" for i in range(60)]),
]


def test_counts_match_definitions(table):
    rows = EDGES + list(enumerate(CASES, 20))
    got = Q.quality_rules(table(rows)).select("doc_id", "text", "quality.*").collect()
    assert len(got) == len(rows)
    for r in got:
        counts = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert counts == brute(r["text"]), r["text"][:60]


def test_junk_goes_and_prose_stays(table):
    prose = " ".join(f"the house{i} of town{i} is by river{i} and" for i in range(20))
    junk = {
        1: " ".join(f"w{i}*** x{i}&&&" for i in range(40)),
        2: " ".join(f"W{i}ORD!!" for i in range(80)),
        3: " ".join(f"zzz{i}qq" for i in range(80)),
        4: "spam and eggs\n" * 60,
        5: "short and good",
    }
    df = table([(0, prose), *junk.items()])
    kept = Q.keep_quality(df)
    assert kept.columns == df.columns
    assert [r["doc_id"] for r in kept.collect()] == [0]
    why = {r["doc_id"]: r["quality_failed"] for r in Q.quality_rules(df).collect()}
    assert why[0] == [] and "symbols_per_word" in why[1] and "shouting_marks_per_word" in why[2]
    assert "stop_word_share" in why[3]


def test_a_rule_set_is_data(table):
    df = table([(1, "the " + " ".join(f"word{i} of" for i in range(80)))])
    assert Q.keep_quality(df).count() == 1
    strict = (("mean_word_length", "mean_word_chars", 9.0, None),)
    assert Q.keep_quality(df, rules=strict).count() == 0


def test_empty_table(edges):
    none = edges.where("false")
    assert Q.quality_rules(none).count() == 0 and Q.keep_quality(none).count() == 0


def test_filter_stays_above_the_measures(edges):
    plan = Q.keep_quality(edges)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 2 * 2  # words and lines, each made once, shown with its alias


def test_names_of_results_and_working_columns(sf_docs):
    import pytest

    own = ("_q_n", "_q_words", "_q_lines", "_q_repeat", "_q_kept", "_quality", "c0", "c1")
    named = sf_docs.selectExpr("doc_id AS _q_n", "text AS c0", *[f"'{c}' AS {c}" for c in own if c not in ("_q_n", "c0")])
    want = {r["doc_id"]: r["quality_kept"] for r in Q.quality_rules(sf_docs).collect()}
    got = Q.quality_rules(named, text_col="C0")
    assert got.columns == [*named.columns, *Q.RESULTS]
    assert {r["_q_n"]: r["quality_kept"] for r in got.collect()} == want
    assert all(r["_q_words"] == "_q_words" and r["_quality"] == "_quality" for r in got.collect())
    with_results = named.selectExpr("*", "1 AS quality", "2 AS quality_kept")
    kept = Q.keep_quality(with_results, text_col="c0")
    assert kept.columns == with_results.columns and {r["_q_n"] for r in kept.collect()} == {i for i, k in want.items() if k}
    with pytest.raises(ValueError, match="quality, quality_kept"):
        Q.quality_rules(with_results, text_col="c0")
