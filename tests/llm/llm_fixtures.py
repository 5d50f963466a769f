import pytest

CLASHING = ("row_key", "words", "h", "hash", "size", "shard", "unit", "kind", "start", "end", "bin", "fp", "bucket", "n", "x")


@pytest.fixture
def table(spark):
    """documents-like rows (doc_id, text), with extra columns named like
    working columns of the operators."""

    def make(rows, extra=CLASHING):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        schema += "".join(f", {c} string" for c in extra)
        data = [(i, t, "en", "src0", None if t is None else len(t), *["?"] * len(extra)) for i, t in rows]
        return spark.createDataFrame(data, schema)

    return make


@pytest.fixture
def sf_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


EDGES = [
    (None, "a row without an id"),
    (None, None),
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\f\r"),
    (4, "word"),
    (5, "two words"),
    (6, "two words"),
    (6, "two words"),
    (6, "another text of a repeated id"),
    (7, "ÉCOLE   ▁ 日本 😀 é"),
    (8, "very long " * 30_000),
    (-9, "a negative id"),
]


@pytest.fixture
def edges(table):
    return table(EDGES)
