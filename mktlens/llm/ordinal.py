"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade > j | text) = sigmoid(w . x - t_j) with one weight vector for all
grades and ordered thresholds t_0 < t_1 < ... . x is hashed text: for every
white-space token its lower-cased core, its shape (letter case, digits, marks)
and its surrounding marks, averaged over the tokens, and a few features of the
whole text (repeated neighbours, repeated lines). Order is kept by fitting the
first threshold and the logarithms of the gaps. Fitted with numpy (Adam, full
batch) on a bounded sample of graded texts; a grade's texts are weighed by its
share of all labels, so probabilities are calibrated to it.

Results per text: the expected grade, the tail probability of at least
``GOOD``, and whether that is ``SELECT`` or more. Scoring runs in Spark tasks;
a token adds one number, kept for tokens met again in a cache that is emptied
when full, which changes no score. Texts are read whole.

Fitting: at most ``PER_GRADE`` texts of each grade, each of ``MAX_BYTES`` bytes
at most. With fewer than two grades in the sample every text gets that grade
(the top one without labels), so nothing is dropped for want of labels.

Defined results: null, empty and blank texts have x = 0 apart from the
intercepts; repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktlens.llm.sampling import labelled_sample

BUCKETS = 1 << 16
GRADES = 3
GOOD = 1
SELECT = 0.5
PER_GRADE = (1_500, 1_000, 2_500)
MAX_BYTES = 32_768
EPOCHS = 150
RATE = 0.05
DECAY = 1e-5
SCALE = 10.0  # per-token means are small numbers
CACHE = 300_000

EDGES = re.compile(r"^(\W*)(.*?)(\W*)$", re.S)


def _bucket(kind: str, value: str) -> int:
    return zlib.crc32(f"{kind}\t{value}".encode("utf-8", "surrogatepass")) % BUCKETS


def _shape(core: str) -> str:
    kinds = ["A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in core]
    return "".join(k for i, k in enumerate(kinds) if i < 1 or kinds[i - 1] != k)[:8]


def token_features(token: str) -> tuple[int, int, int]:
    before, core, after = EDGES.match(token).groups()
    return _bucket("core", core.lower()), _bucket("shape", _shape(core)), _bucket("marks", f"{before}_{after}")


def text_features(text: str, tokens: list[str]) -> list[tuple[int, float]]:
    """Features of the whole text, on the scale of one token's share."""
    if not tokens:
        return []
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = sum(a == b for a, b in zip(tokens, tokens[1:], strict=False)) / len(tokens)
    again = 1 - len(set(lines)) / len(lines) if lines else 0.0
    trigrams = list(zip(tokens, tokens[1:], tokens[2:], strict=False))
    same = 1 - len(set(trigrams)) / len(trigrams) if trigrams else 0.0
    return [(_bucket("text", "pairs"), pairs), (_bucket("text", "lines"), again), (_bucket("text", "trigrams"), same)]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class OrdinalModel:
    weights: np.ndarray  # per bucket, shared by all grades
    thresholds: np.ndarray  # ascending, one less than there are grades

    def scorer(self):
        weights = self.weights

        class Known(dict):
            def __missing__(self, token):
                if len(self) >= CACHE:
                    self.clear()
                value = self[token] = float(weights[list(token_features(token))].sum())
                return value

        known = Known()

        def score(text: str | None) -> np.ndarray:
            """P(grade >= 1), P(grade >= 2), ..."""
            tokens = (text or "").split()
            total = 0.0
            if tokens:
                total = sum(map(known.__getitem__, tokens)) / len(tokens)
                total += sum(v * weights[b] for b, v in text_features(text, tokens))
            return _sigmoid(SCALE * total - self.thresholds)

        return score


def _incidence(texts: list[str]):
    known: dict[str, tuple[int, int, int]] = {}
    cols, vals, sizes = [], [], []
    for text in texts:
        tokens = (text or "").split()
        seen: dict[int, float] = {}
        for t, n in Counter(tokens).items():
            ids = known.get(t)
            if ids is None:
                ids = known[t] = token_features(t)
            for b in ids:
                seen[b] = seen.get(b, 0.0) + n / len(tokens)
        for b, v in text_features(text or "", tokens):
            seen[b] = seen.get(b, 0.0) + v
        cols.append(np.fromiter(seen.keys(), np.int32, len(seen)))
        vals.append(np.fromiter(seen.values(), np.float32, len(seen)))
        sizes.append(len(seen))
    return np.concatenate(cols), np.concatenate(vals), np.array(sizes)


def train(sample: list[tuple[str, int]], counts: list[int], epochs: int = EPOCHS) -> OrdinalModel:
    """Fit on (text, grade) pairs; ``counts`` are the sizes of the grades that
    the sample was drawn from."""
    grades = len(counts)
    y = np.array([g for _, g in sample], dtype=int)
    present = sorted(set(y.tolist()))
    if len(present) < 2:
        only = present[0] if present else grades - 1
        return OrdinalModel(np.zeros(BUCKETS), np.where(np.arange(grades - 1) < only, -20.0, 20.0))
    cols, vals, sizes = _incidence([t for t, _ in sample])
    rows = np.repeat(np.arange(len(y)), sizes)
    sampled = np.bincount(y, minlength=grades)
    weight = np.array([counts[g] / max(sampled[g], 1) for g in range(grades)])[y]
    weight = weight / weight.sum()
    w = np.zeros(BUCKETS)
    cut = np.concatenate(([-1.0], np.zeros(grades - 2)))  # first threshold, then log gaps
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, cut)]
    for step in range(1, epochs + 1):
        gaps = np.exp(cut[1:])
        t = cut[0] + np.concatenate(([0.0], np.cumsum(gaps)))
        z = np.bincount(rows, vals * w[cols], len(y)) * SCALE
        tail = _sigmoid(z[:, None] - t[None, :])  # P(grade > j)
        hi = np.concatenate((np.ones((len(y), 1)), tail), axis=1)[np.arange(len(y)), y]
        lo = np.concatenate((tail, np.zeros((len(y), 1))), axis=1)[np.arange(len(y)), y]
        like = np.maximum(hi - lo, 1e-12)
        slope = tail * (1 - tail)
        s_hi = np.concatenate((np.zeros((len(y), 1)), slope), axis=1)[np.arange(len(y)), y]
        s_lo = np.concatenate((slope, np.zeros((len(y), 1))), axis=1)[np.arange(len(y)), y]
        d_z = -weight * (s_hi - s_lo) / like
        d_t = np.zeros(grades - 1)
        np.add.at(d_t, y[y > 0] - 1, (weight * s_hi / like)[y > 0])
        np.add.at(d_t, y[y < grades - 1], -(weight * s_lo / like)[y < grades - 1])
        d_w = np.bincount(cols, vals * np.repeat(d_z, sizes), BUCKETS) * SCALE + DECAY * w
        tails = np.cumsum(d_t[::-1])[::-1]
        d_cut = np.concatenate(([tails[0]], tails[1:] * gaps))
        for p, g, s in zip((w, cut), (d_w, d_cut), state, strict=True):
            s[0] = 0.9 * s[0] + 0.1 * g
            s[1] = 0.999 * s[1] + 0.001 * g * g
            p -= RATE * (s[0] / (1 - 0.9**step)) / (np.sqrt(s[1] / (1 - 0.999**step)) + 1e-8)
    gaps = np.exp(cut[1:])
    return OrdinalModel(w, cut[0] + np.concatenate(([0.0], np.cumsum(gaps))))


def grade_of(quality, toxic):
    """The graded rating of a labelled document: 0 poor, 1 passable (well
    formed, but toxic), 2 good. Null without a quality label."""
    ok = F.when(quality.isin(0, 1), quality)
    return F.when(ok == 0, 0).when(ok == 1, F.when(toxic == 1, 1).otherwise(2))


def score_documents(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", good: int = GOOD) -> DataFrame:
    """(doc_id, expected_grade, tail_probability, kept) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("expected_grade double, tail_probability double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        of = shared.value.scorer()
        for s in texts:
            tails = np.array([of(t) for t in s]).reshape(len(s), -1)
            yield pd.DataFrame({"expected_grade": tails.sum(axis=1), "tail_probability": tails[:, good - 1]})

    scored = docs.select(F.col(id_col).alias("doc_id"), score(F.col(text_col)).alias("s"))
    return scored.select(
        "doc_id", "s.expected_grade", "s.tail_probability", (F.col("s.tail_probability") >= SELECT).alias("kept")
    )


def quality_grades(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fit on ``labels`` and score every document."""
    grade = grade_of(F.col("quality"), F.col("toxic"))
    sample, counts = labelled_sample(docs, labels, grade, PER_GRADE, MAX_BYTES, id_col, text_col)
    return score_documents(docs, train(sample, counts), id_col, text_col)
