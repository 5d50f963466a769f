"""Substring dedup over super-k-mers.

A window is ``WINDOW`` consecutive words of one document. Every window has a
minimiser, the least hash among its ``GRAM``-word runs; consecutive windows
with the same minimiser form a super-k-mer. Equal windows have equal
minimisers, so they meet in the minimiser's bucket.

1. One pass names each document's super-k-mers as (minimiser, row, start, n).
   Minimisers are counted; a super-k-mer whose minimiser occurs once anywhere
   holds no repeated window and goes no further.
2. The others travel as one packed string each (their words, one space
   between) to their bucket. Of documents with one text only the first sends
   its strings (no window of the others is fresh), and a string that a batch of
   documents repeats is sent once, for its first place. In a bucket the windows are sorted, and only the
   first place of each window is fresh.
3. Per document: windows named in step 1 that are not fresh are repeats, and
   the words they cover go.

A minimiser met more than ``HOT`` times (a passage that many documents share)
is split: its windows travel one by one to a bucket of their own hash.

Windows are compared as strings; hashes only choose the bucket. Places are
ordered by document id (nulls last), then by the row's key, then by start.
Rows that repeat both id and text are one document and are judged alike; rows
that repeat an id with another text are documents of their own. Null, empty
and short texts lose nothing. Very long texts are one row of numpy arrays.
Ids are integers of any size. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktlens.llm.common import row_key
from mktlens.sources.sinks import materialize

WINDOW = 20
GRAM = 5
HOT = 2_000
SHIFT = 32  # a run (start, n) is packed as start << SHIFT | n

_PRIME = np.uint64(0x9E3779B97F4A7C15)


class _Powers:
    """Powers of an odd constant and of its inverse, modulo 2^64."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)
        self.inverse = np.uint64(pow(int(_PRIME), -1, 1 << 64))

    def upto(self, n: int):
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up), 1 << 16)
            for name, base in (("up", _PRIME), ("down", self.inverse)):
                p = np.full(size, base, dtype=np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up, self.down


_POWERS = _Powers()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def word_prints(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of every word, from one pass over their bytes."""
    joined = b" ".join(words)
    raw = np.frombuffer(joined, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    up, down = _POWERS.upto(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(raw * up[: len(raw)], out=sums[1:])
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    return _mix((sums[ends] - sums[starts]) * down[starts])


def minimisers(prints: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(least gram hash of every window, hash of every gram)."""
    n = len(prints) - gram + 1
    grams = np.zeros(n, dtype=np.uint64)
    for j in range(gram):
        grams = grams * _PRIME + prints[j : j + n]
    grams = _mix(grams)
    least, width, want = grams, 1, window - gram + 1
    while width < want:
        step = min(width, want - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return least, grams


def super_kmers(words: list[bytes], window: int = WINDOW, gram: int = GRAM):
    """(minimiser, start, number of windows, whether the minimiser's gram
    occurs twice in the text) of every run of windows with one minimiser."""
    least, grams = minimisers(word_prints(words), window, gram)
    starts = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    sizes = np.diff(np.append(starts, len(least)))
    values = least[starts]
    ordered = np.sort(grams)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    again = np.isin(values, twice) if len(twice) else np.zeros(len(values), dtype=bool)
    return values, starts, sizes, again


def _name_runs(window: int, gram: int):
    schema = pa.schema([("row_key", pa.int64()), ("minimiser", pa.int64()), ("run", pa.int64()), ("again", pa.bool_())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = [], []
            for key, text in zip(batch["row_key"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words = words_of(text)
                if len(words) >= window:
                    found.append(super_kmers(words, window, gram))
                    keys.append(np.full(len(found[-1][0]), key, dtype=np.int64))
            if found:
                values, starts, sizes, again = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(keys)),
                        pa.array(values.view(np.int64)),
                        pa.array((starts.astype(np.int64) << SHIFT) | sizes),
                        pa.array(again),
                    ],
                    schema=schema,
                )

    return of


def _bucket_of(window: bytes) -> int:
    """Bucket of a single window of a hot minimiser."""
    return int(_mix(word_prints([window]))[0].astype(np.int64))


def _pack(window: int):
    """Rows (row_key, no_id, doc_id, text, runs, minimisers, hot) to packed
    strings, each with the first place that this batch has for it."""

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            first: dict[tuple[int, bytes], tuple] = {}
            for key, no_id, doc_id, text, runs, mins, hots in frame.itertuples(index=False, name=None):
                words = words_of(text)
                for run, minimiser, hot in zip(runs, mins, hots, strict=True):
                    start, n = int(run) >> SHIFT, int(run) & ((1 << SHIFT) - 1)
                    if hot:
                        parts = [(b" ".join(words[s : s + window]), s) for s in range(start, start + n)]
                        parts = [(_bucket_of(w), w, s) for w, s in parts]
                    else:
                        parts = [(int(minimiser), b" ".join(words[start : start + n + window - 1]), start)]
                    for bucket, packed, s in parts:
                        place = (bool(no_id), int(doc_id), int(key), s)
                        if (bucket, packed) not in first or place < first[bucket, packed]:
                            first[bucket, packed] = place
            if first:
                yield pd.DataFrame(
                    [(b, w, *p) for (b, w), p in first.items()],
                    columns=["bucket", "packed", "no_id", "doc_id", "row_key", "start"],
                )

    return of


PACKED = "bucket long, packed binary, no_id boolean, doc_id long, row_key long, start long"


def fresh_runs(rows: list[tuple], window: int = WINDOW) -> list[tuple[int, int]]:
    """(row_key, run) of the windows of one bucket that start nowhere earlier.
    rows: (packed, no_id, doc_id, row_key, start)."""
    rows.sort(key=lambda r: r[1:])
    if len({r[0] for r in rows}) == 1:
        rows = rows[:1]  # the same string again holds nothing new
    windows = []
    for i, (packed, *_rest) in enumerate(rows):
        words = packed.split(b" ")
        windows += [(b" ".join(words[j : j + window]), i, j) for j in range(len(words) - window + 1)]
    windows.sort()
    fresh: dict[int, list[int]] = {}
    last = None
    for w, i, j in windows:
        if w != last:
            fresh.setdefault(i, []).append(j)
            last = w
    out = []
    for i, js in fresh.items():
        _packed, _none, _doc, key, start = rows[i]
        at = np.sort(np.array(js, dtype=np.int64))
        cuts = np.flatnonzero(np.concatenate(([True], np.diff(at) != 1)))
        for a, n in zip(at[cuts], np.diff(np.append(cuts, len(at))), strict=True):
            out.append((key, ((start + int(a)) << SHIFT) | int(n)))
    return out


def _count_windows(window: int):
    """Partitions of packed strings, sorted by bucket, to fresh runs."""

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        bucket = None
        out: list[tuple[int, int]] = []
        for frame in frames:
            for b, *row in frame.itertuples(index=False, name=None):
                if b != bucket and rows:
                    out += fresh_runs(rows, window)
                    rows = []
                bucket = b
                rows.append((bytes(row[0]), bool(row[1]), int(row[2]), int(row[3]), int(row[4])))
            if out:
                yield pd.DataFrame(out, columns=["row_key", "run"])
                out = []
        if rows:
            yield pd.DataFrame(fresh_runs(rows, window), columns=["row_key", "run"])

    return of


def covered_words(n_words: int, named, fresh, window: int = WINDOW) -> np.ndarray:
    """Mask of the words inside a named window that is not fresh."""
    repeated = np.zeros(n_words + 1, dtype=np.int64)
    for sign, runs in ((1, named), (-1, fresh)):
        runs = np.asarray(runs if runs is not None else [], dtype=np.int64)
        starts, sizes = runs >> SHIFT, runs & ((1 << SHIFT) - 1)
        np.add.at(repeated, starts, sign)
        np.add.at(repeated, starts + sizes, -sign)
    at = np.flatnonzero(np.cumsum(repeated)[:-1] > 0)
    edges = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + window, -1)
    return np.cumsum(edges)[:-1] > 0


def _cut(window: int):
    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            n_words, n_removed, kept = [], [], []
            for text, named, fresh in zip(frame["text"], frame["runs"], frame["fresh"], strict=True):
                words = words_of(text)
                n_words.append(len(words))
                if named is None or not len(named):
                    n_removed.append(0)
                else:
                    gone = covered_words(len(words), named, fresh, window)
                    n_removed.append(int(gone.sum()))
                    words = [w for w, g in zip(words, gone, strict=True) if not g]
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pd.DataFrame(
                {
                    "no_id": frame["no_id"],
                    "doc_id": frame["doc_id"],
                    "n_words": n_words,
                    "n_removed": n_removed,
                    "kept_text": kept,
                }
            )

    return of


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every row."""
    rows = docs.select(
        row_key(F.col(id_col), F.col(text_col)).alias("row_key"),
        # Ids without nulls: with them they would pass through pandas as doubles.
        F.col(id_col).isNull().alias("no_id"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(0)).alias("doc_id"),
        F.col(text_col).alias("text"),
    )
    runs = materialize(
        rows.select("row_key", "text").mapInArrow(
            _name_runs(window, gram), "row_key long, minimiser long, run long, again boolean"
        ),
        "super-kmers",
    )
    met = runs.groupBy("minimiser").agg(F.count("*").alias("n"), F.max("again").alias("again"))
    met = met.where((F.col("n") > 1) | F.col("again")).select("minimiser", (F.col("n") > HOT).alias("hot"))
    named = materialize(
        runs.select("row_key", "minimiser", "run")
        .join(met, "minimiser")
        .groupBy("row_key")
        .agg(F.sort_array(F.collect_set(F.struct("run", "minimiser", "hot"))).alias("x"))
        .select(
            "row_key",
            F.col("x.run").alias("runs"),
            F.col("x.minimiser").alias("minimisers"),
            F.col("x.hot").alias("hots"),
        ),
        "named-runs",
    )
    # Copies of a whole text, by two independent 64-bit hashes: the first one stands for all.
    text = F.coalesce("text", F.lit(""))
    first = (
        rows.groupBy(F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("copy"), text).alias("h2"))
        .agg(F.min(F.struct("no_id", "doc_id", "row_key")).alias("x"))
        .select(F.col("x.row_key").alias("row_key"))
    )
    packed = (
        rows.join(named.join(first, "row_key", "left_semi"), "row_key")
        .select("row_key", "no_id", "doc_id", "text", "runs", "minimisers", "hots")
        .mapInPandas(_pack(window), PACKED)
    )
    fresh = (
        packed.repartition("bucket")
        .sortWithinPartitions("bucket")
        .select("bucket", "packed", "no_id", "doc_id", "row_key", "start")
        .mapInPandas(_count_windows(window), "row_key long, run long")
        .groupBy("row_key")
        .agg(F.collect_set("run").alias("fresh"))
    )
    return (
        rows.join(named.select("row_key", "runs"), "row_key", "left")
        .join(fresh, "row_key", "left")
        .select("no_id", "doc_id", "text", "runs", "fresh")
        .mapInPandas(_cut(window), "no_id boolean, doc_id long, n_words long, n_removed long, kept_text string")
        .select(F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "n_words", "n_removed", "kept_text")
    )
