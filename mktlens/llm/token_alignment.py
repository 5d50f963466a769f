"""Cross-tokenizer alignment by inverted bitmaps of token pairs.

Two tokenizers cut the same bytes (a blank and the text) in different places.
Where both end a token, a group ends; within a group every token of one side
whose bytes overlap a token of the other is linked to it. A pair of ids is
scored by how many documents of the whole corpus hold it linked.

* Documents are worked on in blocks. A block keeps, for each pair of ids, one
  compressed bitmap of its documents for each binary digit of how often a
  document holds the link (a plane): only non-zero bytes are stored, as (plane,
  byte's place, byte). Bits of single documents are merged by OR; the popcount
  of the OR over the planes is the pair's documents, the popcounts of the
  planes, weighted, are its links.
* Blocks hold different documents, so a pair's bitmap over the corpus is the
  bitmaps of its blocks side by side and its popcount the sum of theirs. Only
  (block, pair, popcount) travels to the counts, and (block, pair, score) back.
* The scores meet their block's bitmaps, whose set bits are the postings: each
  adds the score to its document, weighted by its plane.

Nothing is kept for a hot document, pair or text: a block is bounded by
``BLOCK_CHARS`` (a longer text is a block of its own), a pair has one row in a
block, and a first id has at most as many pairs as the other vocabulary.

Within a block a text is cut at blanks where both tokenizers are known to end a
token (``_units``), so that a unit met again is encoded and aligned once.

Defined results: null and empty texts, and texts that either tokenizer does not
give back byte by byte, have no tokens and zeros everywhere; repeated rows count
as documents of their own; null ids are kept; other columns are ignored; an
empty table gives an empty result. Very long texts are handled whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mktlens.sources.sinks import materialize

# Public vocabularies, on every executor; the paths are parameters.
MODEL_A = "/opt/tokenizers/byte_bpe_50k.json"
MODEL_B = "/opt/tokenizers/piece_bpe_32k.model"
BLOCK_CHARS = 8_000_000
BLOCK_DOCS = 1 << 18
BATCH_UNITS = 32_768  # units encoded at a time
KEPT_UNITS = 500_000  # units that a task keeps from block to block
KEPT_CHARS = 16_000_000
SPACE = "▁"
# Units over which encoders of any age agree: no rare white space, and only
# letters that have long been letters.
PLAIN = re.compile(r" [!-~\n\u00A1-\u024F]{0,400}")
# Fixed value: how a byte-level tokenizer cuts text into words.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# White space that no unit may begin or end at: tokenizer A joins runs of it.
MIXED = re.compile(r"\A |  | \Z|\n (?:\n|\Z)|[^\S\n ]")


def _byte_chars() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable ones for themselves, the others numbered from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _digits(ids: int, last: str) -> np.ndarray:
    return np.array([f"{i}{last}".encode() for i in range(ids)])


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and how to write ids."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        chars = _byte_chars()
        vocab = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            if all(c in chars for c in entry):
                self.bytes_a[i] = bytes(chars[c] for c in entry)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        self.size_a = np.array([len(x) for x in self.bytes_a])
        self.size_b = np.array([len(x) for x in self.bytes_b])
        words = type(self.a.pre_tokenizer).__name__ == "ByteLevel" and self.a.normalizer is None
        # Units are sound if no piece of B runs on over a blank and A cuts by words.
        self.cut = words and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        self.plain = self._ranked(vocab, path_a) if words else None
        na, nb = len(self.bytes_a), len(self.bytes_b)
        self.mid_a, self.end_a = _digits(na, ","), _digits(na, "|")
        self.mid_b, self.end_b = _digits(nb, ","), _digits(nb, ";")

    def _ranked(self, vocab: dict[str, int], path: str):
        """A's own vocabulary for the quicker of two public encoders, if its
        merges are numbered in their order, as that one takes them to be."""
        import tiktoken

        with open(path, encoding="utf-8") as f:
            merges = json.load(f)["model"]["merges"]
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in merges]
        least = min((vocab[m] for m in merged), default=0)
        ranks = {self.bytes_a[i]: i for i in vocab.values() if self.bytes_a[i]}
        if [vocab[m] for m in merged] != list(range(least, least + len(merged))) or any(bytes([x]) not in ranks for x in range(256)):
            return None
        return tiktoken.Encoding("a", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode_a(self, units: list[str]) -> list[list[int]]:
        if self.plain is None:
            return [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        plain = [PLAIN.fullmatch(u) is not None for u in units]
        other = [i for i, same in enumerate(plain) if not same]
        out = [self.plain(u) if same else [] for u, same in zip(units, plain, strict=True)]
        if other:
            for i, e in zip(other, self.a.encode_batch_fast([units[i] for i in other], add_special_tokens=False), strict=True):
                out[i] = e.ids
        return out


@lru_cache(maxsize=2)
def load(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def _units(text: str, cut: bool) -> list[str]:
    """The text as units, each to be read with a blank before it, so that the
    tokens of the text are those of its units one after another. Both
    tokenizers end a token between a character that is no white space and a
    single blank; a text with other runs of white space is one unit."""
    return [text] if not cut or MIXED.search(text) else text.split(" ")


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
    return np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=int(sizes.sum())), sizes


def _same_bytes(tokens: list[bytes], sizes: np.ndarray, ids: np.ndarray, n: np.ndarray, units: list[bytes]) -> np.ndarray:
    """Whether the tokens of each unit, ``n`` of ``ids``, have its bytes."""
    want = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
    have = np.bincount(np.repeat(np.arange(len(units)), n), sizes[ids], len(units)).astype(np.int64)
    joined, wanted = b"".join(map(tokens.__getitem__, ids.tolist())), b"".join(units)
    if joined == wanted and (have == want).all():
        return np.ones(len(units), dtype=bool)
    ends, own = np.cumsum(have).tolist(), have.tolist()
    return np.array([joined[e - k : e] == u for e, k, u in zip(ends, own, units, strict=True)])


class Units:
    """Units met in a task: number, tokens, groups and links of each."""

    def __init__(self, tok: Tokenizers):
        self.tok = tok
        self.known: dict[str, int] = defaultdict(count().__next__)
        self.good = np.zeros(0, dtype=bool)
        self.n_a, self.n_b, self.n_groups, self.n_links, self.links_at, self.keys = (np.zeros(0, dtype=np.int64) for _ in range(6))
        self.groups: list[bytes] = []
        self.chars = 0

    def align(self) -> None:
        """Encodes and aligns the units that are new."""
        fresh = list(islice(self.known, len(self.groups), None))
        for at in range(0, len(fresh), BATCH_UNITS):
            self._add(fresh[at : at + BATCH_UNITS])
        self.links_at = np.cumsum(self.n_links) - self.n_links
        self.chars += sum(map(len, fresh))

    def _add(self, units: list[str]) -> None:
        tok, n = self.tok, len(units)
        blank = [" " + u for u in units]
        raw = [u.encode() for u in blank]
        a, n_a = _flat(tok.encode_a(blank))
        b, n_b = _flat(tok.b.encode(units, num_threads=1))
        good = _same_bytes(tok.bytes_a, tok.size_a, a, n_a, raw) & _same_bytes(tok.bytes_b, tok.size_b, b, n_b, raw)
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        n_a, n_b = n_a * good, n_b * good
        end_a, end_b = np.cumsum(tok.size_a[a]), np.cumsum(tok.size_b[b])
        unit_a = np.repeat(np.arange(n), n_a)
        ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")  # where links end
        twice = np.flatnonzero(ends[1:] == ends[:-1])
        both = ends[twice]  # where groups end
        ends = np.delete(ends, twice)
        at_a = np.searchsorted(end_a, ends)
        keys = a[at_a] * len(tok.bytes_b) + b[np.searchsorted(end_b, ends)]
        group_a, group_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        last_a = both[group_a] == end_a if len(a) else np.zeros(0, dtype=bool)
        last_b = both[group_b] == end_b if len(b) else np.zeros(0, dtype=bool)
        written = np.zeros(len(a) + len(b), dtype=max(tok.end_a.dtype, tok.end_b.dtype))
        written[np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")] = np.where(last_a, tok.end_a[a], tok.mid_a[a])
        written[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = np.where(last_b, tok.end_b[b], tok.mid_b[b])
        width, stops = written.itemsize, np.cumsum(n_a + n_b)
        text, starts = written.tobytes(), stops - n_a - n_b
        self.groups += [
            text[i * width : j * width].replace(b"\0", b"")[:-1] for i, j in zip(starts.tolist(), stops.tolist(), strict=True)
        ]
        self.good = np.concatenate([self.good, good])
        self.keys = np.concatenate([self.keys, keys])
        for name, new in (
            ("n_a", n_a),
            ("n_b", n_b),
            ("n_groups", np.bincount(unit_a[last_a], minlength=n)),
            ("n_links", np.bincount(unit_a[at_a], minlength=n)),
        ):
            setattr(self, name, np.concatenate([getattr(self, name), new]))


class Block:
    """Documents that are aligned together."""

    def __init__(self, units: Units):
        self.units = units
        self.ids: list = []
        self.of, self.sizes = array("i"), array("q")
        self.chars = 0

    def add(self, doc_id, text: str | None) -> None:
        units = _units(text, self.units.tok.cut) if text else []
        self.of.extend(map(self.units.known.__getitem__, units))
        self.sizes.append(len(units))
        self.ids.append(doc_id)
        self.chars += len(text or "")

    def full(self) -> bool:
        return self.chars >= BLOCK_CHARS or len(self.ids) >= BLOCK_DOCS

    def align(self) -> None:
        self.units.align()
        n = len(self.ids)
        of, sizes = np.frombuffer(self.of, dtype=np.int32), np.frombuffer(self.sizes, dtype=np.int64)
        doc = np.repeat(np.arange(n), sizes)
        self.good = np.ones(n, dtype=bool)
        self.good[doc[~self.units.good[of]]] = False
        kept = self.good[doc]
        units = max(1, len(self.units.groups))
        codes = np.sort(doc[kept] * units + of[kept])
        at = _changes(codes)
        self.times = np.diff(at, append=len(codes))
        self.doc, self.unit = codes[at] // units, codes[at] % units

    def total(self, name: str) -> np.ndarray:
        """A count of the units, summed over each document."""
        out = np.zeros(len(self.ids), dtype=np.int64)
        np.add.at(out, self.doc, getattr(self.units, name)[self.unit] * self.times)
        return out

    def groups(self) -> Iterator[bytes]:
        at, of, groups = 0, self.of, self.units.groups
        for n, good in zip(self.sizes, self.good.tolist(), strict=True):
            yield b";".join([groups[u] for u in of[at : at + n]]) if good else b""
            at += n

    def pairs(self) -> dict[str, np.ndarray | pa.Array]:
        """Pair by pair: ids, documents, links and planes."""
        n = self.units.n_links[self.unit]
        first = np.repeat(self.units.links_at[self.unit] - (np.cumsum(n) - n), n)
        shift = max(1, len(self.ids) - 1).bit_length()
        both = self.units.keys[first + np.arange(len(first))] << shift | np.repeat(self.doc, n)
        order = np.argsort(both)
        both, times = both[order], np.repeat(self.times, n)[order]
        starts = _changes(both)
        times = np.add.reduceat(times, starts) if len(starts) else times
        key, doc = both[starts] >> shift, both[starts] & ((1 << shift) - 1)
        # The bits of a pair's documents, merged by OR, and their popcount.
        ids = key[_changes(key)]
        k, _, bits = _merged(key, doc)
        docs = np.bincount(np.searchsorted(ids, k), np.bitwise_count(bits), len(ids)).astype(np.int64)
        links, rows, entries = np.zeros(len(ids), dtype=np.int64), [], []
        for p in range(int(times.max(initial=0)).bit_length()):
            on = (times >> p) & 1 == 1
            k, byte, bits = _merged(key[on], doc[on])
            row = np.searchsorted(ids, k)
            links += np.bincount(row, np.bitwise_count(bits), len(ids)).astype(np.int64) << p
            rows.append(row)
            entries.append(np.stack([np.full(len(k), p), byte >> 8, byte & 255, bits], axis=1).astype(np.uint8))
        row = np.concatenate([*rows, np.zeros(0, dtype=np.int64)])
        packed = np.concatenate([*entries, np.zeros((0, 4), dtype=np.uint8)])[np.argsort(row, kind="stable")]
        ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(ids)))]) * 4
        planes = pa.Array.from_buffers(
            pa.binary(), len(ids), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(packed.tobytes())]
        )
        b = len(self.units.tok.bytes_b)
        return {"a": ids // b, "b": ids % b, "docs": docs, "links": links, "planes": planes}


def _changes(*cols: np.ndarray) -> np.ndarray:
    """Places of sorted rows that differ from the one before."""
    new = np.ones(len(cols[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols]) if len(new) else False
    return np.flatnonzero(new)


def _merged(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The non-zero bytes of each key's bitmap of documents: key, place, byte."""
    byte, bit = doc >> 3, np.left_shift(1, doc & 7).astype(np.uint8)
    at = _changes(key, byte)
    return key[at], byte[at], np.bitwise_or.reduceat(bit, at) if len(at) else bit


def _blocks(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[Block]:
    tok = load(path_a, path_b)
    block = Block(Units(tok))
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            block.add(doc_id.as_py(), text.as_py())
            if block.full():
                block.align()
                yield block
                spent = block.units.chars > KEPT_CHARS or len(block.units.groups) > KEPT_UNITS
                block = Block(Units(tok) if spent else block.units)
    if block.ids:
        block.align()
        yield block


def _inputs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def token_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str = MODEL_A, path_b: str = MODEL_B
) -> DataFrame:
    """(doc_id, groups): the alignment of every row, as ``a1,a2|b1;a3|b2,b3`` in
    decimal ids; '' for a row without tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, path_a, path_b):
            ids, groups, size = [], [], 0
            for i, g in zip(block.ids, block.groups(), strict=True):
                ids.append(i)
                groups.append(g.decode())
                size += len(g)
                if size > BLOCK_CHARS:
                    yield _batch({"doc_id": (ids, id_type), "groups": (groups, pa.string())})
                    ids, groups, size = [], [], 0
            yield _batch({"doc_id": (ids, id_type), "groups": (groups, pa.string())})

    rows = _inputs(docs, id_col, text_col)
    id_type = _arrow(rows.schema["doc_id"].dataType)
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("groups", T.StringType())]))


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _batch(columns: dict[str, tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], names=list(columns))


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _inverted(docs: DataFrame, id_col: str, text_col: str, path_a: str, path_b: str) -> DataFrame:
    """Rows of two kinds, block by block: documents (``a`` null) with their place
    in the block, counts and digest; pairs with documents, links and planes."""
    rows = _inputs(docs, id_col, text_col)
    id_field = rows.schema["doc_id"]
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            id_field,
            T.StructField("place", T.IntegerType()),
            *[T.StructField(c, T.LongType()) for c in COUNTS],
            T.StructField("groups_sha256", T.StringType()),
            T.StructField("a", T.IntegerType()),
            T.StructField("b", T.IntegerType()),
            T.StructField("docs", T.LongType()),
            T.StructField("links", T.LongType()),
            T.StructField("planes", T.BinaryType()),
        ]
    )
    kinds = {f.name: _arrow(f.dataType) for f in schema.fields}

    def whole(n: int, **columns) -> pa.RecordBatch:
        arrays = [
            columns[c].cast(k) if isinstance(columns.get(c), pa.Array) else pa.array(columns[c], k) if c in columns else pa.nulls(n, k)
            for c, k in kinds.items()
        ]
        return pa.RecordBatch.from_arrays(arrays, names=list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId() << 32
        for i, block in enumerate(_blocks(batches, path_a, path_b)):
            n = len(block.ids)
            digests = [hashlib.sha256(g).hexdigest() if g else "" for g in block.groups()]
            counts = {c: block.total(c) for c in COUNTS}
            number = {"block": np.full(n, task | i)}
            yield whole(n, **number, doc_id=block.ids, place=np.arange(n), **counts, groups_sha256=digests)
            pairs = block.pairs()
            n = len(pairs["a"])
            yield whole(n, block=np.full(n, task | i), **pairs)

    return rows.mapInArrow(run, schema)


def _pair_counts(pairs: DataFrame) -> DataFrame:
    """(a, b, docs, links) over all blocks."""
    return pairs.groupBy("a", "b").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))


def pair_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str = MODEL_A, path_b: str = MODEL_B
) -> DataFrame:
    """(a, b, docs, links) of every linked pair of ids: documents that hold it,
    and link occurrences, corpus-wide."""
    inverted = materialize(_inverted(docs, id_col, text_col, path_a, path_b), "token-pairs")
    return _pair_counts(inverted.where("a is not null"))


def align(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str = MODEL_A, path_b: str = MODEL_B
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of
    every row. A link is best if no pair of its first id is in more documents;
    ``count_sum`` adds up the documents of the pairs of all links. The groups
    themselves are in ``token_groups``."""
    inverted = materialize(_inverted(docs, id_col, text_col, path_a, path_b), "token-pairs")
    pairs = inverted.where("a is not null").select("block", "a", "b", "docs", "links")
    counts = _pair_counts(pairs).select("a", "b", F.col("docs").alias("score"))
    best = F.col("score") == F.max("score").over(Window.partitionBy("a"))
    # The pairs of a block find their scores by narrow rows; the bitmaps stay behind.
    scored = pairs.join(counts.withColumn("best", best), ["a", "b"]).select(
        *[F.col(c).alias(f"_{c}") for c in ("block", "a", "b", "score", "best")]
    )
    id_field = inverted.schema["doc_id"]
    out = T.StructType(
        [
            id_field,
            *[T.StructField(c, T.LongType()) for c in (*COUNTS, "n_best", "count_sum")],
            T.StructField("groups_sha256", T.StringType()),
        ]
    )

    def post(rows: pa.Table, scores: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        is_doc = pc.is_null(rows["a"])
        own, kept = rows.filter(is_doc), rows.filter(pc.invert(is_doc))
        column = lambda t, c: t[c].to_numpy().astype(np.int64)
        n_best, count_sum = np.zeros(len(own), dtype=np.int64), np.zeros(len(own), dtype=np.int64)
        if len(kept):
            wide = 1 << 32
            key, known = column(kept, "a") * wide + column(kept, "b"), column(scores, "_a") * wide + column(scores, "_b")
            order = np.argsort(known)
            at = order[np.searchsorted(known[order], key)]
            score = column(scores, "_score")[at]
            top = pc.cast(scores["_best"], pa.int8()).to_numpy().astype(np.int64)[at]
            entries = pc.binary_length(kept["planes"]).to_numpy().astype(np.int64) // 4
            packed = np.frombuffer(b"".join(kept["planes"].to_pylist()), dtype=np.uint8).reshape(-1, 4)
            pair = np.repeat(np.arange(len(kept)), entries)
            entry, bit = np.nonzero(np.unpackbits(packed[:, 3:], axis=1, bitorder="little"))
            byte = packed[:, 1].astype(np.int64) << 8 | packed[:, 2]
            place, times = byte[entry] * 8 + bit, np.left_shift(np.int64(1), packed[entry, 0].astype(np.int64))
            np.add.at(n_best, place, times * top[pair[entry]])
            np.add.at(count_sum, place, times * score[pair[entry]])
        place = column(own, "place")
        extra = {"n_best": n_best[place], "count_sum": count_sum[place]}
        return pa.table([pa.array(extra[f.name]) if f.name in extra else own[f.name] for f in out.fields], names=out.names)

    return inverted.groupBy("block").cogroup(scored.groupBy("_block")).applyInArrow(post, out)

