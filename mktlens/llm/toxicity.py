"""Toxicity: averaged subword embeddings under a linear softmax.

A word is the bag of its character n-grams (with its edges marked), each hashed
to a bucket with a vector. A word's vector is the mean of its n-grams', a
text's the mean of its words', and a linear softmax reads the text's vector.
Bucket vectors and softmax are trained jointly (Adam, full batch, numpy) on a
bounded sample of labelled texts, so a misspelt word that training never saw
still gets most of its n-grams' weight. Training starts from n-grams that stand
out among toxic texts and stops where a held-out part of the sample is
predicted best, so a few hundred labels do not lead to learning single texts.
Only passes that moved the bucket vectors are judged; ``SubwordModel.passes``
says how many of them the kept model had.

Scoring runs in Spark tasks. As everything after the buckets is linear, a word
contributes one number, which a task keeps for words met again; that cache is
emptied when full, which changes no score. A text is read whole.

Fitting: at most ``PER_CLASS`` texts of either class, each of ``MAX_BYTES`` bytes
at most. If a class has no usable text, every score is the toxic share of the
labels (0 without labels).

Defined results: null, empty and wordless texts are scored by the intercept;
repeated rows score alike; repeated labels of an id count as clean if any is;
other columns are ignored.
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

WORDS = re.compile(r"\w+")
GRAMS = (3, 5)
BUCKETS = 1 << 16
DIM = 8
EPOCHS = 24
WARM = 20  # passes for softmax and intercept alone
BATCH = 512
RATES = (0.01, 0.01, 0.02)  # bucket vectors, softmax, intercept
DECAY = 1e-5
HELD = 0.2
SCREEN = 2.0
SMALL = 1e-3
CALIBRATION_HOLD = 1.0
SCALE = 10.0  # a few telling words among hundreds must move the mean
PER_CLASS = (4_500, 1_500)  # clean, toxic
MAX_BYTES = 32_768
CACHE = 300_000
THRESHOLD = 0.7


def subwords(word: str, grams: tuple[int, int] = GRAMS, buckets: int = BUCKETS) -> list[int]:
    marked = f"<{word}>"
    found = [marked]
    for n in range(grams[0], grams[1] + 1):
        found += [marked[i : i + n] for i in range(len(marked) - n + 1)]
    return [zlib.crc32(g.encode("utf-8", "surrogatepass")) % buckets for g in found]


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


@dataclass
class SubwordModel:
    """``weights``: what a bucket adds to the log-odds of the toxic class."""

    weights: np.ndarray
    bias: float
    passes: int = 0  # joint passes that the kept weights had; 0 if untrained

    def word(self, word: str) -> float:
        return float(self.weights[subwords(word, buckets=len(self.weights))].mean())

    def scorer(self):
        model = self

        class Known(dict):
            def __missing__(self, word):
                if len(self) >= CACHE:
                    self.clear()
                value = self[word] = model.word(word)
                return value

        known = Known()

        def score(text: str | None) -> float:
            words = words_of(text)
            logit = self.bias
            if words:
                logit += sum(map(known.__getitem__, words)) / len(words)
            return float(1.0 / (1.0 + np.exp(-np.clip(logit, -30.0, 30.0))))

        return score


def _batch(texts: list[str], buckets: int, known: dict[str, np.ndarray]):
    """(buckets, weights, sizes): a row per text, its mean over words of mean n-grams."""
    cols, vals, sizes = [], [], []
    for text in texts:
        words = Counter(words_of(text))
        total = sum(words.values())
        c, v = [np.zeros(0, np.int32)], [np.zeros(0, np.float32)]
        for w, n in words.items():
            ids = known.get(w)
            if ids is None:
                ids = known[w] = np.array(subwords(w, buckets=buckets), dtype=np.int32)
            c.append(ids)
            v.append(np.full(len(ids), n / (total * len(ids)), dtype=np.float32))
        ids, back = np.unique(np.concatenate(c), return_inverse=True)
        cols.append(ids)
        vals.append(np.bincount(back, np.concatenate(v), len(ids)).astype(np.float32))
        sizes.append(len(ids))
    return np.concatenate(cols), np.concatenate(vals), np.array(sizes)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _calibrated(logit: np.ndarray, target: np.ndarray, prior: float) -> tuple[tuple[float, float], float]:
    """((slope, shift), loss): what fits the held-out texts best, weighed to the
    labels' true odds exp(prior) and held near (1, prior) by a weak penalty."""
    toxic = 1 / (1 + np.exp(-prior))
    weight = np.where(target == 1, toxic / target.sum(), (1 - toxic) / (len(target) - target.sum()))
    hold = CALIBRATION_HOLD / len(target)
    log_slope, shift = 0.0, prior
    for _ in range(1000):
        slope = np.exp(log_slope)
        error = weight * (_sigmoid(slope * logit + shift) - target)
        log_slope -= 0.5 * ((error * logit).sum() * slope + hold * log_slope)
        shift -= 0.5 * (error.sum() + hold * (shift - prior))
    p = np.clip(_sigmoid(np.exp(log_slope) * logit + shift), 1e-6, 1 - 1e-6)
    loss = -(weight * np.log(np.where(target == 1, p, 1 - p))).sum()
    return (float(np.exp(log_slope)), float(shift)), float(loss)


@dataclass
class _Rows:
    cols: np.ndarray
    vals: np.ndarray
    sizes: np.ndarray
    target: np.ndarray

    def read(self, per_bucket: np.ndarray) -> np.ndarray:
        """Each text's sum of what its buckets add."""
        starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        values = np.append(self.vals * per_bucket[self.cols], np.float32(0))
        return np.where(self.sizes > 0, np.add.reduceat(values, starts), 0.0)


def _rows(texts: list[str], target: np.ndarray, buckets: int, known: dict) -> _Rows:
    return _Rows(*_batch(texts, buckets, known), target)


def train(
    sample: list[tuple[str, int]],
    counts: list[int],
    buckets: int = BUCKETS,
    dim: int = DIM,
    epochs: int = EPOCHS,
    seed: int = 7,
) -> SubwordModel:
    """Fit on (text, 0 or 1) pairs; ``counts`` are the class sizes that the
    sample was drawn from, by which the intercept is put right.

    With two classes the softmax depends on the difference of the logits
    alone, so one number per bucket and text is passed each way."""
    texts = [t for t, _ in sample]
    y = np.array([g for _, g in sample], dtype=np.float64)
    if len(set(y.tolist())) < 2:
        share = counts[1] / sum(counts) if sum(counts) else 0.0
        share = min(max(share, 1e-9), 1 - 1e-9)
        return SubwordModel(np.zeros(buckets, np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    # Stratified order: the first HELD share of each class judges when to stop.
    held, fit = [], []
    for g in (0, 1):
        own = rng.permutation(np.flatnonzero(y == g))
        cut = int(len(own) * HELD)
        held.append(own[:cut])
        fit.append(own[cut:])
    held, fit = np.concatenate(held), rng.permutation(np.concatenate(fit))
    known: dict[str, np.ndarray] = {}
    batches = [
        _rows([texts[i] for i in rows], y[rows], buckets, known)
        for rows in (fit[at : at + BATCH] for at in range(0, len(fit), BATCH))
    ]
    # Without a held-out text of either class nothing can be judged.
    judge = _rows([texts[i] for i in held], y[held], buckets, known) if len(set(y[held].tolist())) == 2 else None
    prior = float(np.log(counts[1] / counts[0])) if counts[0] and counts[1] else 0.0
    known.clear()

    # Start: the first dimension holds how far a bucket's count among toxic
    # texts stands out, in standard deviations beyond SCREEN; the rest is small.
    share = y[fit].mean()
    seen = sum(np.bincount(r.cols, minlength=buckets) for r in batches)
    toxic = sum(np.bincount(r.cols, np.repeat(r.target, r.sizes), buckets) for r in batches)
    z = (toxic - seen * share) / np.sqrt(seen * share * (1 - share) + 1)
    start = np.sign(z) * np.maximum(np.abs(z) - SCREEN, 0)
    spread = np.concatenate([r.read(start) for r in batches]).std()
    embed = rng.normal(0, SMALL, (buckets, dim)).astype(np.float32)
    embed[:, 0] = start / (spread * SCALE) if spread > 0 else 0
    soft = rng.normal(0, 1 / dim, (dim, 2)).astype(np.float32)
    soft[0] = (-0.5, 0.5)
    bias = np.zeros(2, np.float32)
    params = [embed, soft, bias]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    best, kept, step = np.inf, None, 0
    for epoch in range(WARM + epochs):
        for r in batches:
            step += 1
            logit = r.read(embed @ (soft[:, 1] - soft[:, 0])) * SCALE + bias[1] - bias[0]
            weight = np.where(r.target == 1, 0.5 / share, 0.5 / (1 - share)) / len(r.target)
            # Error of the second logit; the first has its negative.
            error = ((_sigmoid(logit) - r.target) * weight).astype(np.float32)
            back = np.bincount(r.cols, r.vals * np.repeat(error, r.sizes), buckets).astype(np.float32) * SCALE
            both = np.stack([-back, back], axis=1)
            grads = [both @ soft.T + DECAY * embed, embed.T @ both, np.array([-error.sum(), error.sum()])]
            for i, (q, g) in enumerate(zip(params, grads, strict=True)):
                if i == 0 and epoch < WARM:
                    continue  # softmax and intercept first
                first[i] += 0.1 * (g - first[i])
                second[i] += 0.001 * (g * g - second[i])
                q -= RATES[i] * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        odds = (embed @ (soft[:, 1] - soft[:, 0])) * SCALE
        joint = epoch + 1 - WARM
        if judge is None:
            kept = (odds, float(bias[1] - bias[0]), joint, 1.0, prior)
        elif joint > 0:
            # Classes were weighed alike; their true odds come back with the scale.
            logit = judge.read(odds) + bias[1] - bias[0]
            scale, loss = _calibrated(logit, judge.target, prior)
            if loss < best:
                best, kept = loss, (odds, float(bias[1] - bias[0]), joint, *scale)
            elif loss > best * 2:
                break
    odds, intercept, passes, slope, shift = kept
    return SubwordModel(odds * slope, intercept * slope + shift, passes)


def score_documents(docs: DataFrame, model: SubwordModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = shared.value.scorer()
        for s in texts:
            yield pd.Series([of(t) for t in s], dtype="float64")

    return docs.select(F.col(id_col).alias("doc_id"), score(F.col(text_col)).alias("score"))


def held_out(id_col):
    """The third of the ids that is never learnt from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; learns from the
    labels outside the held-out third."""
    grade = F.when(~held_out(F.col(id_col)), F.col("toxic").cast("int"))
    grade = F.when(grade.isin(0, 1), grade)
    sample, counts = labelled_sample(docs, labels, grade, PER_CLASS, MAX_BYTES, id_col, text_col)
    scored = score_documents(docs, train(sample, counts), id_col, text_col)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
