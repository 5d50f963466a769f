"""Secret scans with multipart credential linking.

Strong finds (``BASE``) are reported wherever they stand. Weak finds (``WEAK``)
alone say little: a long mixed token, an account name, a service address. They
are parts of a credential, and a part is reported only when at most ``SCOPE``
code points lie between it and a complementary part (``COMPLEMENTS``) in the
same document, however long the two are; strong finds count as parts, too.

The interval join runs on (document, role, bin of ``SCOPE`` code points), with a
part in every bin that it reaches. Before it the parts are reduced to the least
start and the greatest end in each bin, which is all that an existence test
needs, so a document full of parts makes no pairs. A text with no match of any
pattern leaves no row. Places come from the gaps between matches, summed in
order; texts themselves are never shuffled.

Defined results: null and empty texts have no finds; repeated rows are judged
alike; other columns are ignored, or kept by ``redact_secrets``, whose working
columns carry a prefix. Places count code points, the end is exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mktlens.llm.common import row_name
from mktlens.sources.sinks import materialize

# Kind, pattern, least length of the last group (or of the match).
BASE = (
    (
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    # Runs below the least length are dropped, so only runs of 24 or more are sought.
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
WEAK = (
    (
        "ident",
        r"""(?i:(?:access_key_id|client_id|account_id|user(?:name)?|login)["']?\x20*[:=]\x20*["']?)[A-Za-z0-9_.@+-]{4,}""",
        0,
        0,
    ),
    ("key", r"[A-Za-z0-9+/_]{32,}={0,2}", 0, 32),
    ("endpoint", r"(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+", 0, 0),
)
KINDS = tuple(k for k, *_ in (*BASE, *WEAK))
BASE_KINDS = tuple(k for k, *_ in BASE)
ROLE = {"assign": "secret", "access": "ident", "hex": "secret", "ident": "ident", "key": "secret", "endpoint": "endpoint"}
COMPLEMENTS = {"ident": ("secret",), "secret": ("ident", "endpoint"), "endpoint": ("secret",)}
SCOPE = 200
MASK = "[SECRET]"


def _matches(text: Column, pattern: str, group: int) -> Column:
    """Array of (gap before, length, length of the group, text) of all matches."""
    whole = F.regexp_extract_all(text, F.lit(pattern), 0)
    value = F.regexp_extract_all(text, F.lit(pattern), group) if group else whole
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    return F.when(
        F.regexp_like(text, F.lit(pattern)),
        F.transform(
            F.arrays_zip(whole.alias("m"), value.alias("v"), gaps.alias("g")),
            lambda x: F.struct(
                x["g"].alias("gap"), F.length(x["m"]).alias("size"), F.length(x["v"]).alias("value"), x["m"].alias("m")
            ),
        ),
    )


def _candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row_key, kind, start, end) of every match long enough."""
    text = F.col("_t")
    marked = F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))
    needs = {"assign": marked, "ident": marked, "endpoint": F.contains(text, F.lit("://"))}
    found = [
        F.struct(
            F.lit(kind).alias("kind"),
            F.lit(least).alias("least"),
            F.when(needs.get(kind, F.lit(True)), _matches(text, pattern, group)).alias("found"),
        )
        for kind, pattern, group, least in (*BASE, *WEAK)
    ]
    rows = (
        docs.select(
            row_name(F.col(id_col), F.col(text_col)).alias("row_key"), F.coalesce(F.col(text_col), F.lit("")).alias("_t")
        )
        .select("row_key", F.array(*found).alias("kinds"))
        .select("row_key", F.filter("kinds", lambda k: F.size(k["found"]) > 0).alias("kinds"))
        .where(F.size("kinds") > 0)
        .withColumn("row", F.monotonically_increasing_id())
        .select("row", "row_key", F.explode("kinds").alias("k"))
        .select("row", "row_key", "k.kind", "k.least", F.posexplode("k.found").alias("i", "x"))
        .where(F.col("x.size").isNotNull() | F.col("x.gap").isNotNull())
    )
    order = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("end", F.sum(F.col("x.gap") + F.coalesce(F.col("x.size"), F.lit(0))).over(order))
    mixed = F.col("x.m").rlike("[A-Z]") & F.col("x.m").rlike("[a-z]") & F.col("x.m").rlike("[0-9]")
    return (
        placed.where((F.col("x.value") >= F.col("least")) & ((F.col("kind") != "key") | mixed))
        .select(
            "row_key", "kind", (F.col("end") - F.col("x.size")).cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end")
        )
        .distinct()
    )


def _role(kind: Column) -> Column:
    return F.coalesce(*[F.when(kind == k, F.lit(r)) for k, r in ROLE.items()])


def _linked(parts: DataFrame) -> DataFrame:
    """The weak candidates with a complementary part in scope."""
    bin_of = lambda c: F.floor(F.col(c) / SCOPE)
    parts = parts.withColumn("role", _role(F.col("kind")))
    parts = parts.withColumn("bin", bin_of("start")).withColumn("end_bin", bin_of("end"))
    upto = Window.partitionBy("row_key").orderBy("start", F.col("end").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    strong = F.col("kind").isin(*BASE_KINDS)
    parts = parts.withColumn("_inside", F.max(F.when(strong, F.col("end"))).over(upto))
    free = parts.where(strong | F.col("_inside").isNull() | (F.col("_inside") < F.col("end"))).drop("_inside")
    reached = free.withColumn("other_bin", F.explode(F.sequence("bin", "end_bin")))
    bins = reached.groupBy("row_key", F.col("role").alias("other"), "other_bin").agg(
        F.min("start").alias("first"), F.max("end").alias("last")
    )
    others = F.coalesce(
        *[F.when(F.col("role") == r, F.array(*[F.lit(c) for c in cs])) for r, cs in COMPLEMENTS.items()]
    )
    weak = (
        free.where(~strong)
        .withColumn("other", F.explode(others))
        .withColumn("other_bin", F.explode(F.sequence(F.col("bin") - 1, F.col("end_bin") + 1)))
    )
    # Parts that reach the same bin are less than a bin apart.
    near = (
        F.when(bins["other_bin"] < weak["bin"], bins["last"] >= weak["start"] - SCOPE)
        .when(bins["other_bin"] > weak["end_bin"], bins["first"] <= weak["end"] + SCOPE)
        .otherwise(F.lit(True))
    )
    same = [weak[c] == bins[c] for c in ("row_key", "other", "other_bin")]
    on = same[0] & same[1] & same[2] & near
    return weak.join(bins, on, "left_semi").select("row_key", "kind", "start", "end").distinct()


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row_key, finds): for every row with a find, the array of (start, rank,
    kind, end), sorted; rank is the kind's place in ``KINDS``."""
    parts = materialize(_candidates(docs, id_col, text_col), "secret-parts")
    strong = parts.where(F.col("kind").isin(*BASE_KINDS))
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(KINDS)])
    return (
        strong.unionByName(_linked(parts))
        .groupBy("row_key")
        .agg(F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end"))).alias("finds"))
    )


def spans_text(finds: Column) -> Column:
    return F.array_join(
        F.transform(finds, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, finds) of every row; an empty array where nothing was found."""
    every = docs.select(F.col(id_col).alias("doc_id"), row_name(F.col(id_col), F.col(text_col)).alias("row_key"))
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    found = find_secrets(docs, id_col, text_col)
    return every.join(found, "row_key", "left").select("doc_id", F.coalesce("finds", none).alias("finds"))


def _merged(finds: Column) -> Column:
    """Sorted finds to disjoint (start, end) spans."""
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def step(acc, x):
        last = F.element_at(acc, -1)
        apart = (F.size(acc) == 0) | (last["end"] < x["start"])
        new = F.struct(x["start"].alias("start"), x["end"].alias("end"))
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when(apart, F.concat(acc, F.array(new))).otherwise(
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(grown))
        )

    return F.aggregate(finds, none, step)


def redact_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars", mask: str = MASK
) -> DataFrame:
    """All rows and columns of the input, each span of a find replaced by
    ``mask``; ``chars_col``, if the table has it, gets the new length of the
    texts that changed."""
    found = find_secrets(docs, id_col, text_col).select(
        F.col("row_key").alias("_sec_key"), _merged(F.col("finds")).alias("_sec_spans")
    )
    left = docs.withColumn("_sec_key", row_name(F.col(id_col), F.col(text_col)))
    both = left.join(found, "_sec_key", "left")
    text, spans = F.col(text_col), F.col("_sec_spans")
    # Texts are cut by code points: a span's piece is what precedes it and the mask.
    upto = lambda i: F.coalesce(F.when(i > 0, F.get(spans, i - 1)["end"]), F.lit(0))
    pieces = F.transform(
        spans,
        lambda x, i: F.concat(
            F.substring(text, (upto(i) + 1).cast("int"), (x["start"] - upto(i)).cast("int")), F.lit(mask)
        ),
    )
    tail = F.substring(text, (F.element_at(spans, -1)["end"] + 1).cast("int"), F.length(text))
    changed = spans.isNotNull()
    out = both.withColumn("_sec_text", F.when(changed, F.concat(F.array_join(pieces, ""), tail)).otherwise(text))
    cols = []
    for c in docs.columns:
        if c == text_col:
            cols.append(F.col("_sec_text").alias(c))
        elif c == chars_col:
            kind = docs.schema[c].dataType
            cols.append(F.when(changed, F.length("_sec_text").cast(kind)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return out.select(*cols)
