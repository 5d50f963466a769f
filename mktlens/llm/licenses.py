"""License scans: a trained paragraph classifier, confirmed by templates.

A paragraph is a line of a text; a line of many sentences is cut at sentence
ends into runs of about ``SEGMENT_WORDS`` words. Its features are the word one-
and two-grams that occur in the templates, present or not, and the share of its
words that no template has. A multinomial logistic regression (numpy, full
batch) over these sparse features gives each licence family and the class
``unknown`` a probability.

A notice inside a longer line is seen by itself, whatever stands around it: each
sentence, and each run of words in which the two-grams of one template follow
each other (at most ``STEPS`` words apart), is judged like a paragraph of its
own. Of those found the ones with most two-grams win where they overlap, so a
line may have several finds. A paragraph found as a whole is one find, unless
other families stand in it with two-grams that its own does not have.

Training texts are made from the templates (words dropped, runs cut out,
versions and years changed, foreign words around) and, for ``unknown``, from
paragraphs of the documents and from template words in random order. A part of
them is held out to calibrate: a temperature for all classes and a shift of
``unknown`` such that at most ``FALSE_SHARE`` of held-out unknown paragraphs
pass as a licence.

A prediction is reported if its calibrated probability is at least ``REPORT``
and the predicted family's templates confirm it: of the two-grams of one
template, or of the paragraph, at least ``CONFIRM`` are shared, and at least
``LEAST_SHARED`` in number. Paragraphs with fewer shared two-grams than that
cannot be confirmed and are not put to the classifier.

Fitting takes at most ``BACKGROUND_DOCS`` documents (those with the least id
hashes, each of ``MAX_BYTES`` bytes at most) and ``BACKGROUND`` paragraphs; all
documents are then scanned whole.

Defined results: null, empty and blank texts have no paragraph; repeated rows
are judged alike; other columns are ignored; an empty table gives an empty
result. Places count code points, the end is exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktlens.llm.sampling import least_hashes

# Usual notices and opening paragraphs of public licences.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        'on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License.",
    ),
    "mit": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation.",
    ),
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "isc": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc0": (
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this "
        "work.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "This work is in the public domain.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright 2020 the authors. All rights reserved.",
        "No part of this publication may be reproduced or transmitted in any form without the prior written permission of "
        "the publisher.",
    ),
}
UNKNOWN = "unknown"
# Plain sentences, so that ``unknown`` never lacks examples.
PLAIN = (
    "The weather was fine and the children went to the beach in the morning.",
    "You can find a copy of the report on the table in the hall.",
    "This version of the story is different from the one I know.",
    "The program starts at eight and ends with a free concert.",
    "Permission to enter the building is given by the guard.",
    "All of the work was done by hand in the old workshop.",
    "The law requires that notice be given under these conditions.",
    "He reserved a table for two at the restaurant.",
)

WORDS = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
SENTENCE = re.compile(r"(?<=[.!?:;])\s+")
SEGMENT_WORDS = 40
BACKGROUND_DOCS = 300
BACKGROUND = 2_000
MAX_BYTES = 32_768
COPIES = 30
EPOCHS = 200
FALSE_SHARE = 0.005
REPORT = 0.5
CONFIRM = 0.6
LEAST_SHARED = 2
STEPS = (1, 3, 8)  # words from one two-gram of a run to the next
LEAST_RUN = 7  # two-grams of the shortest run cut out for training


def words_of(paragraph: str) -> list[str]:
    return WORDS.findall(paragraph.lower())


def pairs_of(words: list[str]) -> list[tuple[str, str]]:
    return list(zip(words, words[1:], strict=False))


def _bare(at: int, piece: str) -> tuple[int, int, str] | None:
    """(start, end, piece) without the blanks around it."""
    bare = piece.strip()
    start = at + len(piece) - len(piece.lstrip())
    return (start, start + len(bare), bare) if bare else None


def lines(text: str) -> Iterator[tuple[int, str, list[tuple[int, int, str]]]]:
    """(start, line, paragraphs) of a text's lines, long ones cut at sentences."""
    at = 0
    for line in text.split("\n"):
        if line.count(" ") < SEGMENT_WORDS:
            pieces = [(at, line)]
        else:
            cuts = [0, *(m.end() for m in SENTENCE.finditer(line)), len(line)]
            pieces, begin = [], 0
            for end in cuts[1:]:
                if end == len(line) or line.count(" ", begin, end) >= SEGMENT_WORDS:
                    pieces.append((at + begin, line[begin:end]))
                    begin = end
        yield at, line, [x for x in (_bare(*piece) for piece in pieces) if x]
        at += len(line) + 1


def paragraphs(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, paragraph) of a text."""
    for _, _, found in lines(text):
        yield from found


class Templates:
    """Vocabulary and two-grams of the templates."""

    def __init__(self):
        self.families = [*TEMPLATES, UNKNOWN]
        self.grams: list[list[frozenset]] = [
            [frozenset(pairs_of(words_of(t))) for t in texts] for texts in TEMPLATES.values()
        ]
        self.pairs = frozenset(g for texts in self.grams for t in texts for g in t)
        self.family_pairs = [frozenset(g for t in texts for g in t) for texts in self.grams]
        self.having: dict[tuple[str, str], list[tuple[int, int]]] = {}  # (family, template) of a two-gram
        for f, texts in enumerate(self.grams):
            for i, t in enumerate(texts):
                for g in t:
                    self.having.setdefault(g, []).append((f, i))
        grams = sorted({w for texts in TEMPLATES.values() for t in texts for w in words_of(t)})
        grams += sorted(self.pairs)
        self.column = {g: i for i, g in enumerate(grams)}

    def features(self, words: list[str]) -> tuple[list[int], float]:
        """Columns present, and the share of words that no template has."""
        column = self.column
        known = [column[w] for w in set(words) if w in column]
        missing = sum(w not in column for w in words) / len(words) if words else 1.0
        return known + [column[g] for g in set(pairs_of(words)) if g in column], missing

    def similarity(self, family: int, shared: set, total: int) -> float:
        """Greatest share of a template's, or of the paragraph's, two-grams
        that the two have in common. ``shared``: the paragraph's two-grams
        that some template has; ``total``: all of the paragraph's."""
        best = 0.0
        for grams in self.grams[family]:
            both = len(grams & shared)
            if both >= min(LEAST_SHARED, len(grams)) and both:
                best = max(best, both / len(grams), both / total if both >= 2 * LEAST_SHARED else 0.0)
        return best


TEMPLATE_SET = Templates()


def _made(rng: np.random.Generator, words: list[str], around: list[str]) -> list[str]:
    """A variant of a template's words."""
    out = list(words)
    if len(out) > 12 and rng.random() < 0.5:
        n = int(rng.integers(max(8, len(out) // 3), len(out) + 1))
        at = int(rng.integers(0, len(out) - n + 1))
        out = out[at : at + n]
    drop = rng.uniform(0, 0.15)
    out = [w for w in out if rng.random() >= drop] or list(words)
    out = [str(rng.integers(1, 9)) if re.fullmatch(r"\d(\.\d)?", w) and rng.random() < 0.5 else w for w in out]
    if around and rng.random() < 0.4:
        left = rng.choice(around, int(rng.integers(0, 12))).tolist()
        right = rng.choice(around, int(rng.integers(0, 12))).tolist()
        out = [*left, *out, *right]
    return out


def _runs(hits: list[int], step: int) -> Iterator[tuple[int, int]]:
    """(first, last) of the runs of ascending places at most ``step`` apart."""
    first = last = hits[0]
    for i in hits[1:]:
        if i - last > step:
            yield first, last
            first = i
        last = i
    yield first, last


@dataclass(frozen=True)
class Find:
    start: int
    end: int
    family: int
    probability: float
    pairs: frozenset  # two-grams shared with the family

    def meets(self, other: Find) -> bool:
        return self.start < other.end and other.start < self.end

    def foreign(self, family: int) -> bool:
        """Of another family, with two-grams that this one does not have."""
        return self.family != family and not self.pairs <= TEMPLATE_SET.family_pairs[family]


@dataclass
class LicenseModel:
    weights: np.ndarray  # (columns + 1, classes); the last row is for the missing share
    bias: np.ndarray
    temperature: float
    shift: float  # added to the calibrated logit of unknown

    def probabilities(self, words: list[str]) -> np.ndarray:
        known, missing = TEMPLATE_SET.features(words)
        z = self.bias + missing * self.weights[-1]
        if known:
            z = z + self.weights[known].sum(axis=0) / np.sqrt(len(known))
        z = z / self.temperature
        z[-1] += self.shift
        p = np.exp(z - z.max())
        return p / p.sum()

    def judged(self, words: list[str]) -> tuple[int, float] | None:
        """(family, probability) of words that are reported."""
        p = self.probabilities(words)
        family = int(p.argmax())
        return (family, float(p[family])) if family < len(TEMPLATE_SET.grams) and p[family] >= REPORT else None

    def whole(self, start: int, end: int, piece: str) -> Find | None:
        """The find of a paragraph or sentence judged as a whole."""
        words = words_of(piece)
        pairs = set(pairs_of(words))
        shared = pairs & TEMPLATE_SET.pairs
        if len(shared) < LEAST_SHARED or not (got := self.judged(words)):
            return None
        if TEMPLATE_SET.similarity(got[0], shared, len(pairs)) < CONFIRM:
            return None
        return Find(start, end, *got, frozenset(shared & TEMPLATE_SET.family_pairs[got[0]]))

    def runs(self, at: int, line: str) -> list[Find]:
        """Finds among the runs of words that follow one template."""
        spans = [m.span() for m in WORDS.finditer(line)]
        words = [line[a:b].lower() for a, b in spans]
        pairs = pairs_of(words)
        places: dict[tuple[int, int], list[int]] = {}
        for i, g in enumerate(pairs):
            for t in TEMPLATE_SET.having.get(g, ()):
                places.setdefault(t, []).append(i)
        out, seen = [], {}
        for (family, i), hits in places.items():
            grams = TEMPLATE_SET.grams[family][i]
            if len(hits) < min(LEAST_SHARED, len(grams)):
                continue
            for first, last in {r for step in STEPS for r in _runs(hits, step)}:
                inside = set(pairs[first : last + 1])
                both = len(inside & grams)
                if both < min(LEAST_SHARED, len(grams)):
                    continue
                if both < CONFIRM * len(grams) and (both < LEAST_RUN or both < CONFIRM * len(inside)):
                    continue
                if (first, last) not in seen:
                    seen[first, last] = self.judged(words[first : last + 2])
                if (got := seen[first, last]) and got[0] == family:
                    out.append(Find(at + spans[first][0], at + spans[last + 1][1], *got, frozenset(inside & grams)))
        return out

    def line_finds(self, at: int, line: str, pieces: list[tuple[int, int, str]]) -> list[Find]:
        whole = [f for f in (self.whole(*piece) for piece in pieces) if f]
        parts = self.runs(at, line)
        cuts = [0, *(m.end() for m in SENTENCE.finditer(line)), len(line)]
        if len(cuts) > 2:
            sentences = (_bare(at + a, line[a:b]) for a, b in zip(cuts, cuts[1:], strict=False))
            parts += [f for f in (self.whole(*x) for x in sentences if x) if f]
        # A part that reaches over another family's notice gives way to its own shorter one.
        parts.sort(key=lambda f: f.start)
        starts = [f.start for f in parts]

        def reaches_over(f: Find) -> bool:
            near = parts[bisect_left(starts, f.start) : bisect_left(starts, f.end)]
            less = [x for x in near if x != f and x.end <= f.end]
            own = [x for x in less if x.family == f.family]
            return bool(own) and any(x.foreign(f.family) and not all(x.meets(y) for y in own) for x in less)

        parts = [f for f in parts if not reaches_over(f)]
        chosen: list[Find] = []  # disjoint, by start
        starts = []
        for f in sorted(parts, key=lambda f: (-len(f.pairs), f.end - f.start, f.start, f.family)):
            i = bisect_left(starts, f.start)
            if not any(f.meets(x) for x in chosen[max(i - 1, 0) : i + 1]):
                chosen.insert(i, f)
                starts.insert(i, f.start)
        out, gone = [], set()
        for f in whole:
            near = chosen[max(bisect_left(starts, f.start) - 1, 0) : bisect_left(starts, f.end)]
            inside = [x for x in near if x.meets(f) and x not in gone]
            others = [x for x in inside if x.foreign(f.family)]
            gone.update(x for x in inside if x not in others)
            alike = [x for x in inside if x.family == f.family]
            out += alike if others and alike else [f]
        chosen = [x for x in chosen if x not in gone]
        return sorted([*out, *chosen], key=lambda f: (f.start, f.end, f.family))

    def find(self, text: str | None) -> tuple[int, list[tuple[int, str, int, float]]]:
        """(number of paragraphs, finds as (start, family, end, probability))."""
        n, finds = 0, []
        for at, line, pieces in lines(text or ""):
            n += len(pieces)
            if len(TEMPLATE_SET.pairs.intersection(pairs_of(words_of(line)))) >= LEAST_SHARED:
                finds += self.line_finds(at, line, pieces)
        return n, [(f.start, TEMPLATE_SET.families[f.family], f.end, f.probability) for f in finds]


def _logits(x: np.ndarray, missing: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    return x @ weights[:-1] + missing[:, None] * weights[-1] + bias


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def train(background: list[str], seed: int = 11) -> LicenseModel:
    """Fit on variants of the templates against background paragraphs. Those
    that a template covers are no examples of ``unknown`` and are left out."""
    rng = np.random.default_rng(seed)
    ts = TEMPLATE_SET
    unknown = len(ts.families) - 1
    plain = [words_of(b) for b in (*PLAIN * COPIES, *background[:BACKGROUND])]
    around = sorted({w for p in plain for w in p})
    samples: list[tuple[list[str], int]] = []
    for f, texts in enumerate(TEMPLATES.values()):
        for t in texts:
            samples += [(_made(rng, words_of(t), around), f) for _ in range(COPIES)]
    vocabulary = [w for w in ts.column if isinstance(w, str)]
    for words in plain:
        pairs = set(pairs_of(words))
        if words and max(ts.similarity(f, pairs & ts.pairs, len(pairs)) for f in range(unknown)) < CONFIRM:
            samples.append((words, unknown))
    for _ in range(20 * COPIES):
        samples.append((rng.choice(vocabulary, int(rng.integers(3, 25))).tolist(), unknown))
    x = np.zeros((len(samples), len(ts.column)), dtype=np.float32)
    missing = np.zeros(len(samples))
    for i, (words, _) in enumerate(samples):
        known, missing[i] = ts.features(words)
        if known:
            x[i, known] = 1 / np.sqrt(len(known))
    y = np.array([f for _, f in samples])
    order = rng.permutation(len(y))
    held, fit = order[: len(order) // 5], order[len(order) // 5 :]
    classes = len(ts.families)
    weights, bias = np.zeros((x.shape[1] + 1, classes)), np.zeros(classes)
    goal = np.eye(classes)[y]
    size = np.bincount(y[fit], minlength=classes)
    share = (1 / np.maximum(size, 1))[y[fit]]
    share /= share.sum()
    speed = [np.zeros_like(weights), np.zeros_like(bias)]
    for _ in range(EPOCHS):
        error = (_softmax(_logits(x[fit], missing[fit], weights, bias)) - goal[fit]) * share[:, None]
        grad = np.vstack((x[fit].T @ error, missing[fit] @ error)) + 1e-5 * weights
        speed[0] = 0.9 * speed[0] + grad
        speed[1] = 0.9 * speed[1] + error.sum(axis=0)
        weights -= 4.0 * speed[0]
        bias -= 4.0 * speed[1]
    z = _logits(x[held], missing[held], weights, bias)
    temperatures = np.geomspace(0.2, 5, 40)
    loss = [-np.log(_softmax(z / t)[np.arange(len(held)), y[held]] + 1e-12).mean() for t in temperatures]
    temperature = float(temperatures[int(np.argmin(loss))])
    z = z / temperature
    margin = (z[:, :-1].max(axis=1) - z[:, -1])[y[held] == unknown]
    shift = max(0.0, float(np.quantile(margin, 1 - FALSE_SHARE))) if len(margin) else 0.0
    return LicenseModel(weights, bias, temperature, shift)


def background_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("t"))
    some = least_hashes(texts.where(F.col("id").isNotNull()), F.col("id"), docs.count(), BACKGROUND_DOCS)
    rows = some.where(F.octet_length("t") <= MAX_BYTES).collect()
    found = [p for r in rows for _, _, p in paragraphs(r["t"])]
    return found[:: max(1, len(found) // BACKGROUND)][:BACKGROUND]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_paragraphs, finds) of every row; finds is an array of
    (start, family, end, probability) in text order."""
    model = train(background_paragraphs(docs, id_col, text_col))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    finds = "array<struct<start:long,family:string,end:long,probability:double>>"

    @F.pandas_udf(f"n_paragraphs long, finds {finds}")
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = ("start", "family", "end", "probability")
        for s in texts:
            found = [shared.value.find(t) for t in s]
            yield pd.DataFrame(
                {
                    "n_paragraphs": [n for n, _ in found],
                    "finds": [[dict(zip(names, x, strict=True)) for x in xs] for _, xs in found],
                }
            )

    scanned = docs.select(F.col(id_col).alias("doc_id"), scan(F.col(text_col)).alias("s"))
    return scanned.select("doc_id", "s.n_paragraphs", "s.finds")
