import re

import pytest
from llm_fixtures import EDGES, edges, sf_docs, table  # noqa: F401

from mktlens.llm import secrets as S

ASSIGN = re.compile(
    r"""((?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def base(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def weak(text):
    """The linking rule by the gap between two parts, pair by pair."""
    text = text or ""
    strong = base(text)
    parts = [(a, b, k) for a, _, k, b in strong]
    for kind, pattern, _, least in S.WEAK:
        for m in re.finditer(pattern, text, re.A):
            ok = kind != "key" or all(re.search(c, m[0]) for c in ("[A-Z]", "[a-z]", "[0-9]"))
            if ok and len(m[0]) >= least and not any(a <= m.start() and m.end() <= b for a, _, _, b in strong):
                parts.append((m.start(), m.end(), kind))
    out = set()
    for a, b, kind in parts:
        near = {S.ROLE[k] for x, y, k in parts if x - b <= S.SCOPE and a - y <= S.SCOPE}
        if kind not in S.BASE_KINDS and near & set(S.COMPLEMENTS[S.ROLE[kind]]):
            out.add((a, S.KINDS.index(kind), kind, b))
    return sorted(out)


KEY = "aB3" * 13 + "x"
ACCESS = "AKIA" + "Z9" * 8
CASES = [
    'password = "abc"',
    "password = abcdef",
    "PassWord':  'abcdef secret:token:abcdef",
    'password: "token": abcdefgh',
    "token = token = abcdef",
    "xAPI_KEY=0123456789abcdef01234567 apikey:short",
    f"é日本 {ACCESS} 😀 {ACCESS[:-1]} AKIA",
    "0" * 24 + "g" + "f" * 23 + " " + "a" * 40,
    f"{KEY}",  # alone: weak
    f"{ACCESS} and {KEY}",
    f"{ACCESS}{' .' * 150}{KEY}",  # out of scope
    f"client_id = my.name, {KEY} https://host.example/x",
    "https://host.example/x with no secret",
    f"user: somebody {'word ' * 20} token: abcdefgh",
    f"secret={KEY}",
    ("mysql://db.example:1 " + KEY + " ") * 40,
    ("password=abcdefg " * 300),
]
ROWS = EDGES + list(enumerate(CASES, 100)) + [(108, CASES[8]), (109, CASES[9])]


def spans(finds):
    return [(f["start"], f["rank"], f["kind"], f["end"]) for f in finds]


def test_finds_match_brute_force(table):
    got = [(r["doc_id"], spans(r["finds"])) for r in S.secret_report(table(ROWS)).collect()]
    want = [(i, sorted(base(t) + weak(t))) for i, t in ROWS]
    assert sorted(got, key=str) == sorted(want, key=str)
    linked = {i for i, f in want if any(k not in S.BASE_KINDS for _, _, k, _ in f)}
    assert {109, 111} <= linked and not {108, 110, 112} & linked


def test_matches_brute_force_on_the_test_table(sf_docs):
    rows = {r["doc_id"]: r["text"] for r in sf_docs.select("doc_id", "text").collect()}
    for r in S.secret_report(sf_docs).collect():
        assert spans(r["finds"]) == sorted(base(rows[r["doc_id"]]) + weak(rows[r["doc_id"]]))


def test_long_parts_are_linked_by_the_gap_between_them(table):
    key, url, ident = "aB3" * 83 + "x", "https://host.example/" + "p/" * 150 + "?sig=1", "client_id = my.name"
    texts = [f"{key} {ident}", f"{ident} {key}", f"{url} {KEY}", f"{KEY} {url}", f"{'aB3' * 4000} {ident} {'.' * 300} {KEY}"]
    linked = len(texts)
    texts += [f"{key} {'. ' * 150}{ident}", f"{url} {'. ' * 150}{KEY}", f"{key}", f"{url}"]
    for left, right in ((key, ident), (KEY, url), (ident, KEY), (url, key)):
        texts += [f"{'é ' * lead}{left}{' ' * gap}{right}" for lead in (0, 37, 99) for gap in (1, 199, 200, 201, 202, 399)]
    df = table(list(enumerate(texts)))
    got = {r["doc_id"]: spans(r["finds"]) for r in S.secret_report(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == sorted(base(t) + weak(t)), t
    assert all(len(got[i]) == 2 for i in range(linked)) and not any(got[i] for i in range(linked, linked + 4))
    masked = {r["doc_id"]: r["text"] for r in S.redact_secrets(df).collect()}
    assert masked[0] == masked[1] == masked[2] == masked[3] == f"{S.MASK} {S.MASK}"


def test_sql_states_the_same_links(table, spark, tmp_path):
    import duckdb

    from mktlens.llm.queries import ORACLE, QUERIES

    key = "aB3" * 83 + "x"
    texts = [f"{key} client_id = my.name", f"client_id = my.name{'. ' * 101}{key}", f"{KEY} https://host.example/{'p' * 300}"]
    df = table([*ROWS, *enumerate(texts, 300)], extra=()).coalesce(1)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    out = QUERIES["op9_secret_scans"](spark, str(tmp_path))
    want = con.execute(ORACLE["op9_secret_scans"])
    names = [c[0] for c in want.description]
    rows = want.fetchall()
    assert sorted((tuple(r) for r in out.select(*names).collect()), key=str) == sorted(rows, key=str)
    linked = {r[0] for r in rows if any(f"{k}:" in r[names.index("spans")] for k, *_ in S.WEAK)}
    assert {109, 111, 300, 302} <= linked and 301 not in linked


def test_redaction_keeps_rows_and_the_rest_of_texts(table):
    df = table(ROWS)
    out = S.redact_secrets(df)
    assert out.columns == df.columns
    got = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()), key=str)
    want = []
    for i, t in ROWS:
        cuts, at, new = sorted((a, b) for a, _, _, b in base(t) + weak(t)), 0, ""
        merged = []
        for a, b in cuts:
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        for a, b in merged:
            new, at = new + t[at:a] + S.MASK, b
        new = t if not merged else new + t[at:]
        want.append((i, new, None if t is None else len(new)))
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("columns", [("doc_id", "text"), ("text", "doc_id", "n_chars")])
def test_empty_table(edges, columns):
    none = edges.where("false").select(*columns)
    assert S.secret_report(none).count() == 0
    assert S.redact_secrets(none).columns == list(columns) and S.redact_secrets(none).count() == 0
