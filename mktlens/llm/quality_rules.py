"""Quality rules: a threshold table compiled into one Spark projection.

Every rule compares one ratio of a text (length, symbols, stop words, lines)
with a bound. ``RULES`` is data; ``verdict`` folds it into one boolean column,
so a rule set is changed without touching code. Only built-in functions are
used; a document is judged within its own row, so there is no shuffle.

Defined results: null text has no words and fails; empty, blank and very long
texts are judged whole; repeated rows are judged alike. Columns of the input are
kept under any name: rules work on columns named by their place. Only a name of
``RESULTS`` in the input of ``quality_rules`` is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mktlens.llm.common import WORD_SPACE, gram_hashes, shifted, space_words, word_hashes

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for on was be with as by this are at from or an "
    "der die das und von den mit zu ist im für auf nicht ein eine sich auch als des dem "
    "de la le les et en un une du que qui est pour dans par sur au il elle "
    "el los las y del se con por su para no al lo"
).split()

SYMBOLS_RE = r"[#*$%&|<>]"

# (rule, measure, lowest allowed, highest allowed); None leaves a side open.
RULES = (
    ("mean_word_length", "mean_word_chars", 2.5, 14.0),
    ("symbols_per_word", "symbols_per_word", None, 0.25),
    ("shouting_marks_per_word", "marks_per_word", None, 0.5),
    ("upper_case_share", "upper_share", None, 0.5),
    ("stop_word_share", "stop_share", 0.03, None),
    ("repeated_line_share", "dup_line_share", None, 0.6),
)

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _repeat_words(df: DataFrame, words: str) -> DataFrame:
    """Adds ``_q_repeat``: words inside a 3-word window found twice or more.

    Windows are 64-bit hashes; sorting (hash, place) brings equal windows
    together, and the places of repeated ones, in order, give the words covered.
    """
    w = F.col(words)
    df = gram_hashes(df.withColumn("_q_h", word_hashes(w)), "_q_h", 3, "_q_g")
    g = F.col("_q_g")
    df = df.withColumn(
        "_q_s",
        F.when(
            F.size(F.array_distinct(g)) < F.size(g),
            F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
        ),
    )
    s = F.col("_q_s")
    same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
    df = df.withColumn(
        "_q_p",
        F.sort_array(F.transform(F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"])),
    )
    p = F.col("_q_p")
    covered = F.aggregate(
        F.zip_with(p, shifted(p, 1), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))),
        F.lit(0).cast("bigint"),
        lambda acc, x: acc + x,
    )
    return df.withColumn("_q_repeat", F.coalesce(covered, F.lit(0)).cast("bigint")).drop(
        "_q_h", "_q_g", "_q_s", "_q_p"
    )


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus one struct column ``_quality`` with all measures."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.withColumn("_q_words", space_words(F.col(text_col)))
    df = _repeat_words(df, "_q_words")
    words = F.col("_q_words")
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WORD_SPACE)) != "")
    df = df.withColumn("_q_lines", lines)
    n_words = F.size(words).cast("bigint")
    n_lines = F.size("_q_lines").cast("bigint")
    count_of = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("bigint")
    n_upper = F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("bigint")
    n_stop = F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("bigint")
    counted = df.withColumn(
        "_q_n",
        F.struct(
            n_words.alias("n_words"),
            F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            count_of(SYMBOLS_RE).alias("n_symbols"),
            count_of("[!?]").alias("n_marks"),
            (n_lines - F.size(F.array_distinct("_q_lines"))).cast("bigint").alias("n_dup_lines"),
            n_lines.alias("n_lines"),
            F.col("_q_repeat").alias("n_repeat_words"),
            n_upper.alias("n_upper"),
            n_stop.alias("n_stop"),
        ),
    ).drop("_q_words", "_q_lines", "_q_repeat")
    n = F.col("_q_n")
    failed = (n["n_words"] < MIN_WORDS) | (100 * n["n_repeat_words"] > MAX_REPEAT_PERCENT * n["n_words"])
    return counted.withColumn(
        "_quality",
        F.struct(
            n["n_words"].alias("n_words"),
            n["word_chars"].alias("word_chars"),
            n["n_symbols"].alias("n_symbols"),
            n["n_dup_lines"].alias("n_dup_lines"),
            n["n_repeat_words"].alias("n_repeat_words"),
            failed.alias("base_failed"),
            _ratio(n["word_chars"], n["n_words"]).alias("mean_word_chars"),
            _ratio(n["n_symbols"], n["n_words"]).alias("symbols_per_word"),
            _ratio(n["n_marks"], n["n_words"]).alias("marks_per_word"),
            _ratio(n["n_upper"], n["word_chars"]).alias("upper_share"),
            _ratio(n["n_stop"], n["n_words"]).alias("stop_share"),
            _ratio(n["n_dup_lines"], n["n_lines"]).alias("dup_line_share"),
        ),
    ).drop("_q_n")


def failed_rules(measures: Column, rules=RULES) -> Column:
    """Names of the rules that a text breaks, in table order."""
    checks = []
    for name, what, low, high in rules:
        v = measures[what]
        bad = F.lit(False)
        if low is not None:
            bad = bad | (v < low)
        if high is not None:
            bad = bad | (v > high)
        checks.append(F.when(bad, F.lit(name)))
    return F.array_compact(F.array(*checks))


def verdict(measures: Column, rules=RULES) -> Column:
    return ~measures["base_failed"] & (F.size(failed_rules(measures, rules)) == 0)


RESULTS = ("quality", "quality_failed", "quality_kept")


def _by_place(docs: DataFrame, text_col: str) -> tuple[DataFrame, str]:
    """``docs`` with its columns named by their place, so that none can have the
    name of a working column, and what the text column is called then."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = docs.select(text_col).columns[0].lower()
    return docs.toDF(*names), names[[c.lower() for c in docs.columns].index(text)]


def quality_rules(docs: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """``docs`` plus ``quality`` (measures), ``quality_failed`` (broken rules)
    and ``quality_kept``; an input that has one of these columns already is an
    error that names it."""
    taken = sorted(set(RESULTS) & {c.lower() for c in docs.columns})
    if taken:
        raise ValueError(f"the table already has columns named {', '.join(taken)}")
    inner, text = _by_place(docs, text_col)
    m = F.col("_quality")
    judged = measure(inner, text).withColumns({"_failed": failed_rules(m, rules), "_kept": verdict(m, rules)})
    return judged.select(*inner.columns, "_quality", "_failed", "_kept").toDF(*docs.columns, *RESULTS)


def keep_quality(docs: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """The rows that pass, with the columns of the input, whatever their names.

    The verdict passes through a one-element explode: a filter straight on it
    would be moved under the columns it is made of and evaluate them anew."""
    inner, text = _by_place(docs, text_col)
    judged = measure(inner, text).select(
        *inner.columns, F.explode_outer(F.array(verdict(F.col("_quality"), rules))).alias("_q_kept")
    )
    return judged.where("_q_kept").select(*inner.columns).toDF(*docs.columns)
