"""Spelling variants by Bloom-guided neighbourhoods.

Two words of the corpus are near if one inserted, deleted or replaced letter
makes one into the other. A word's form is its most frequent near word, if that
is at least ``RATIO`` times as frequent; following forms leads to its root.

* Words are counted where the texts are read, and combined before they travel.
* The vocabulary goes into blocked Bloom filters, one shard for each word
  length, four bits of one 64-bit block for a word. They are the only thing
  broadcast: ``BITS`` bits for a word, but never more than ``MOST_BLOCKS`` blocks
  (64 MiB); a fuller filter lets more false positives through and loses nothing.
* Every word's edits are probed by hash, without being written out: its
  deletions against the shard of the next shorter words, its replacements
  against its own shard. An insertion is another word's deletion, and of two
  words that differ in one letter the one with the lesser letter is probed, so
  that every pair is met once.
* Only positives travel, as hashes, place and letter. They join the vocabulary
  exactly: by length and hash, then by comparing the edited word letter by
  letter, which leaves no false positive.
* Forms at least double the count, so a chain has at most as many links as the
  greatest count has binary digits; roots are found by doubling steps.

A word has a bounded number of edits, so no word collects an unbounded group.

Defined results: null and empty texts have no words; a null id counts as an
empty one in the rule of planted deletions; repeated rows count again; other
columns are ignored; an empty table gives an empty result; very long words are
probed in blocks, and positives carry no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mktlens.sources.sinks import materialize

MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2
BITS = 16  # of the filter for a word
MOST_BLOCKS = 1 << 23  # of 64 bits
LAST_SHARD = 255  # words of this length or more share a shard
COUNTED = 300_000  # words that a task counts before it sends them on
COUNTED_BYTES = 32_000_000
PROBES = 1 << 20  # edits probed at a time
# Letters a-z and U+00C0 to U+00FF, in UTF-8; A-Z are lower-cased before.
RUN = re.compile(rb"(?:[a-z]++|\xC3[\x80-\xBF])++")
LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], dtype=np.uint8)

_P = 0x9E3779B97F4A7C15  # odd, so it has an inverse
_P_INVERSE = np.uint64(pow(_P, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_P))  # of a letter


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _P, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def counted_words(docs: DataFrame, id_col: str, text_col: str, drop_every: int | None) -> DataFrame:
    """(word, n) of every word met, partly combined.

    With ``drop_every`` one letter is deleted from each run whose
    crc32(id:run) it divides, at the place that the crc names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        size = 0

        def sent() -> pa.RecordBatch:
            kept = {w: n for w, n in total.items() if len(w) >= MIN_LENGTH}
            total.clear()
            words = pa.array(list(kept), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(kept.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = Counter(RUN.findall(text.as_buffer().to_pybytes().lower())) if text.is_valid else {}
                if drop_every:
                    start = zlib.crc32(f"{'' if key is None else key}:".encode())
                    for word, n in found.items():
                        crc = zlib.crc32(word, start)
                        if crc % drop_every == 0:
                            letters = word.decode()
                            at = crc % len(letters)
                            word = (letters[:at] + letters[at + 1 :]).encode()
                        total[word] += n
                else:
                    total.update(found)
                size += sum(map(len, found))
                if len(total) > COUNTED or size > COUNTED_BYTES:
                    yield sent()
                    size = 0
        yield sent()

    return docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(run, "word string, n long")


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    drop_every: int | None = None,
) -> DataFrame:
    """(word, n, size, hash) of the words long and frequent enough; written once."""
    if min_length < MIN_LENGTH:
        raise ValueError(f"words are counted from {MIN_LENGTH} letters on")
    words = (
        counted_words(docs, id_col, text_col, drop_every)
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where((F.length("word") >= min_length) & (F.col("n") >= min_count))
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, hashes = np.zeros(batch.num_rows, dtype=np.int32), np.zeros(batch.num_rows, dtype=np.uint64)
            for rows, letters in _by_length(batch.column(0)):
                sizes[rows], hashes[rows] = letters.shape[1], _hash(letters)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes), pa.array(hashes.view(np.int64))], names=["word", "n", "size", "hash"]
            )

    return materialize(words.mapInArrow(hashed, "word string, n long, size int, hash long"), "vocabulary")


def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The words in groups of one length: places, and a matrix of letters."""
    raw = [w.encode("latin-1") for w in words.to_pylist()]
    sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        yield rows, np.frombuffer(b"".join([raw[r] for r in rows]), dtype=np.uint8).reshape(-1, size)


def _hash(letters: np.ndarray) -> np.ndarray:
    return (_VALUE[letters] * _powers(letters.shape[1])).sum(axis=1, dtype=np.uint64)


class Filters:
    """Where the block of a word is, for each shard of the filters."""

    def __init__(self, words: dict[int, int], most_blocks: int = MOST_BLOCKS):
        share = min(BITS / 64, most_blocks / max(1, sum(words.values())))
        self.blocks = np.zeros(LAST_SHARD + 1, dtype=np.uint64)
        for shard, n in words.items():
            self.blocks[shard] = max(1, int(n * share))
        self.first = (np.cumsum(self.blocks) - self.blocks).astype(np.int64)
        self.size = int(self.blocks.sum())

    def has(self, size: int) -> bool:
        return self.blocks[min(size, LAST_SHARD)] > 0

    def slots(self, size: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Block and bits of words of one length."""
        shard = min(size, LAST_SHARD)
        x = _mix(hashes ^ np.uint64(size))
        block = ((x >> np.uint64(32)) * self.blocks[shard]) >> np.uint64(32)
        bits = np.zeros(len(x), dtype=np.uint64)
        for at in (0, 6, 12, 18):
            bits |= np.uint64(1) << ((x >> np.uint64(at)) & np.uint64(63))
        return block.astype(np.int64) + self.first[shard], bits


def build_filters(vocab: DataFrame, most_blocks: int = MOST_BLOCKS) -> tuple[Filters, np.ndarray]:
    """The filters over a vocabulary: at most ``most_blocks`` numbers, plus one
    for each shard, reach the driver."""
    shard = F.least(F.col("size"), F.lit(LAST_SHARD))
    sizes = {r["shard"]: r["n"] for r in vocab.groupBy(shard.alias("shard")).agg(F.count("*").alias("n")).collect()}
    filters = Filters(sizes, most_blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            for s in np.unique(size).tolist():
                slot, bits = filters.slots(s, hashes[size == s])
                order = np.argsort(slot)
                slot, bits = slot[order], bits[order]
                at = np.flatnonzero(np.diff(slot, prepend=-1))
                merged = np.bitwise_or.reduceat(bits, at).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(slot[at]), pa.array(merged)], names=["slot", "bits"])

    rows = vocab.select("size", "hash").mapInArrow(run, "slot long, bits long")
    found = rows.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(filters.size, dtype=np.uint64)
    table[found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return filters, table


def _edits(letters: np.ndarray, hashes: np.ndarray, filters: Filters) -> Iterator[tuple]:
    """Edits of words of one length, as (length, row, place, letter, hash) with
    one row per edit; letter 0 is a deletion. Of a run of equal letters the last
    is deleted, and letters are replaced by later ones."""
    n, size = letters.shape
    power = _powers(size)
    value = _VALUE[letters] * power
    if filters.has(size - 1):
        after = np.cumsum(value[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
        rest = np.concatenate([after[:, 1:], np.zeros((n, 1), dtype=np.uint64)], axis=1)
        cut = (hashes[:, None] - after) + rest * _P_INVERSE
        last = np.concatenate([letters[:, 1:] != letters[:, :-1], np.ones((n, 1), dtype=bool)], axis=1)
        row, place = np.nonzero(last)
        yield size - 1, row, place, np.zeros(len(row), dtype=np.uint8), cut[row, place]
    for to in LETTERS if filters.has(size) else ():
        row, place = np.nonzero(letters < to)
        put = hashes[row] - value[row, place] + _VALUE[to] * power[place]
        yield size, row, place, np.full(len(row), to), put


def _probe(vocab: DataFrame, filters: Filters, table: np.ndarray) -> DataFrame:
    """The edits that the filters let through: length and hash of the edited
    word, length and hash of the word, place and letter."""
    shared = vocab.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits_of = shared.value
        for batch in batches:
            for _, letters in _by_length(batch.column(0)):
                size = letters.shape[1]
                step = max(1, PROBES // size)
                for at in range(0, len(letters), step):
                    some = letters[at : at + step]
                    hashes = _hash(some)
                    for to_size, row, place, letter, edited in _edits(some, hashes, filters):
                        slot, bits = filters.slots(to_size, edited)
                        hit = np.flatnonzero(bits_of[slot] & bits == bits)
                        if len(hit):
                            fixed = lambda x: pa.array(np.full(len(hit), x, dtype=np.int32))  # noqa: B023, E731
                            yield pa.RecordBatch.from_arrays(
                                [
                                    fixed(to_size),
                                    pa.array(edited[hit].view(np.int64)),
                                    fixed(size),
                                    pa.array(hashes[row[hit]].view(np.int64)),
                                    pa.array(place[hit].astype(np.int32)),
                                    pa.array(letter[hit].astype(np.int32)),
                                ],
                                names=["to_size", "to_hash", "of_size", "of_hash", "place", "letter"],
                            )

    return vocab.select("word").mapInArrow(
        run, "to_size int, to_hash long, of_size int, of_hash long, place int, letter int"
    )


def _edited(word: Column, place: Column, letter: Column) -> Column:
    middle = F.when(letter == 0, F.lit("")).otherwise(F.char(letter))
    return F.concat(F.substring(word, F.lit(1), place), middle, F.substring(word, place + 2, F.length(word)))


def near_words(vocab: DataFrame, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """(word, n, other, other_n): every ordered pair of near words, once."""
    positives = _probe(vocab, *build_filters(vocab, most_blocks))
    named = lambda p: vocab.select(
        F.col("word").alias(p), F.col("n").alias(f"{p}_n"), F.col("size").alias(f"{p}_size"), F.col("hash").alias(f"{p}_hash")
    )
    found = positives.join(named("to"), ["to_size", "to_hash"]).join(named("of"), ["of_size", "of_hash"])
    found = found.where(_edited(F.col("of"), F.col("place"), F.col("letter")) == F.col("to"))
    both = F.array(
        F.struct(F.col("of").alias("word"), F.col("of_n").alias("n"), F.col("to").alias("other"), F.col("to_n").alias("other_n")),
        F.struct(F.col("to").alias("word"), F.col("to_n").alias("n"), F.col("of").alias("other"), F.col("of_n").alias("other_n")),
    )
    return found.select(F.inline(both))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word of (word, form): the end of its chain of
    forms. Each round follows twice as many links as the one before."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = now.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        longer = now.join(step, now["root"] == step["_at"], "left")
        nxt = materialize(longer.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        if nxt.where("moved").isEmpty():
            return nxt.select("word", "root")
        now = nxt.select("word", "root")


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    drop_every: int | None = None,
    most_blocks: int = MOST_BLOCKS,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary."""
    vocab = vocabulary(docs, id_col, text_col, min_length, min_count, drop_every)
    near = near_words(vocab, most_blocks)
    # The greatest count, then the least word.
    per = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    taken = -F.col("best.less") >= ratio * F.col("n")
    words = materialize(
        vocab.select("word", "n")
        .join(per, "word", "left")
        .select(
            "word",
            F.when(taken, F.col("best.other")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(taken, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    ends = roots(words.where(F.col("form").isNotNull()))
    return words.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
