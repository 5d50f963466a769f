"""SentencePiece encoding by sampling without replacement, and decoding.

A text's segmentations into pieces form a lattice. Each piece has a weight
(a power law of its place in the model's vocabulary; the model file holds merge
ranks, not probabilities), a segmentation the product of its pieces' weights,
and its probability is that product over the sum of all. The operator emits the
``k`` segmentations with the greatest Gumbel-perturbed log-probabilities, which
is a sample of k distinct ones without replacement, found by A-star search:

* A node of the search is a set of segmentations: those that share the choices
  for all chunks before some chunk, and avoid some choices there. Its priority
  is the greatest perturbed log-probability in the set, an exact bound: a
  Gumbel at the set's log mass, truncated at its parent's. Popping a node draws
  that best segmentation top-down (the argument of the maximum is independent
  of the maximum) and splits the rest of the set by the first chunk that
  differs. The k nodes popped first give the sample, the next priority is the
  threshold that turns a log-probability into an inclusion probability,
  ``1 - exp(-exp(log_prob - threshold))``.
* Chunks: no piece reaches from another character into a space or over a line
  break, so a text's lattice is a row of small lattices between such places.
* Forward filtering and backward sampling run over the chunks of many texts at
  a time as numpy arrays; sums are kept relative to the last position, so no
  chunk is too long for them. Only the chunk where a popped node must avoid
  choices is walked alone.

Every uniform number is a hash of the row's key, the chunk's place, the step
and the sample, so a retried task, another batch or another cluster draws the
same segmentations.

Characters outside the vocabulary are edges of their own that become byte
pieces; so is a literal U+2581, which would otherwise turn into a space.
Decoding the pieces gives the text back exactly, for any text.

Defined results: null and empty texts have the one empty segmentation (a text
with fewer than ``k`` has fewer samples; the inclusion probability is then 1);
very long texts are handled whole, in blocks of whole chunks; repeated rows are
sampled alike; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mktlens.llm.common import row_key

MODEL = "/opt/tokenizers/piece_bpe_32k.model"  # a parameter of every entry point
K = 2
ALPHA = 1.0  # inverse temperature
MOST_CHARS = 16  # longest piece
BLOCK_CHARS = 1_000_000  # characters of texts, and of chunks, worked on together
NOTED_CHARS = 8_000_000
KEPT_CHARS = 900_000
DECODED = 10_000  # pieces decoded at a time
SPACE = 0x2581
LITERAL = 0x110000  # stands for a U+2581 of the text itself
CHUNKS = re.compile(r" +[^ \n]*|\n|[^ \n]+")

_G1, _G2, _G3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7))
_HASH = np.uint64(0x100000001B3)
_SLOT = 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    """64-bit numbers, hashed, as doubles in (0, 1)."""
    return ((_mix(x) >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)


_ALL = (1 << 64) - 1


def _unit_of(x: int) -> float:
    """``_unit`` of one number."""
    x &= _ALL
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & _ALL
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & _ALL
    return (((x ^ (x >> 31)) >> 12) + 0.5) / (1 << 52)


def _times(k: int, g: np.uint64) -> np.uint64:
    return np.uint64(k * int(g) & _ALL)


class Pieces:
    """The vocabulary: piece lookup by substring hash, weights, bytes."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.bytes: list[bytes] = [b""] * n
        self.byte_ids = np.zeros(256, dtype=np.int32)
        texts: list[str] = [""] * n
        for i in range(n):
            p = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[i] = bytes([int(p[3:-1], 16)])
                self.byte_ids[self.bytes[i][0]] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                texts[i] = p
                self.bytes[i] = p.replace(chr(SPACE), " ").encode("utf-8", "surrogatepass")
        ranked = [i for i in range(n) if texts[i]]
        self.log_weight = np.zeros(n)
        for i in ranked:
            rank = min(-model.get_score(i), n)
            self.log_weight[i] = -alpha * math.log(rank + 2)
        self.fallback = -alpha * math.log(2 * n)
        if max(len(texts[i]) for i in ranked) > MOST_CHARS:
            raise ValueError("a piece is longer than MOST_CHARS")
        # Every start of a piece gets an entry: pieces their id, others an id past n.
        entries = {texts[i]: i for i in ranked}
        longer = set()
        for i in ranked:
            for m in range(1, len(texts[i])):
                start = texts[i][:m]
                longer.add(start)
                entries.setdefault(start, n + len(entries))
        ids = {start: i for i, start in enumerate(sorted(t for t, i in entries.items() if i >= n), n)}
        entries = {t: ids.get(t, i) for t, i in entries.items()}
        total = n + len(ids)
        self.first = np.full(1 << _SLOT, -1, dtype=np.int32)
        self.second = np.full(1 << _SLOT, -1, dtype=np.int32)
        self.prints = np.zeros(total + 1, dtype=np.uint64)
        self.goes_on = np.zeros(total + 1, dtype=bool)  # the last place, id -1, is "nothing"
        for t, i in entries.items():
            h = np.uint64(self._print(t))
            self.prints[i] = h
            self.goes_on[i] = t in longer
            a, b = self.slots(h)
            if self.first[a] < 0:
                self.first[a] = i
            elif self.second[b] < 0:
                self.second[b] = i
            else:
                raise ValueError("two pieces in one slot; choose other hash constants")
        # By piece id; the last place, id -1, is "no piece".
        self.weight = np.append(np.where(self.log_weight < 0, np.exp(self.log_weight), 0.0), 0.0)
        self.size = np.array([len(b) for b in self.bytes], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)
        self.places = np.arange(DECODED * int(self.size.max()))

    @staticmethod
    def _print(text: str) -> int:
        h = 0
        for c in text:
            h = (h * int(_HASH) + ord(c) + 1) & ((1 << 64) - 1)
        return h

    @staticmethod
    def slots(h):
        with np.errstate(over="ignore"):
            return (h * _G1) >> np.uint64(64 - _SLOT), (h * _G2) >> np.uint64(64 - _SLOT)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece or -1, whether some longer piece may start so) of each
        substring hash. Starts of pieces that are no pieces have ids past the
        vocabulary; "may" is never wrongly false."""
        with np.errstate(over="ignore"):
            i = self.first.take((h * _G1) >> np.uint64(64 - _SLOT))
            other = np.flatnonzero(self.prints[i] != h)
            h = h[other]
            j = self.second.take((h * _G2) >> np.uint64(64 - _SLOT))
        j[self.prints[j] != h] = -1
        i[other] = j
        return np.where(i < len(self.bytes), i, -1), self.goes_on[i]

    def decode(self, ids) -> str:
        ids = np.asarray(ids)
        # Some at a time: whole 64-bit indices, which are the fastest, take 8 bytes for each of the text.
        parts = [self._bytes_of(ids[at : at + DECODED]) for at in range(0, len(ids), DECODED)]
        return b"".join(parts)[1:].decode("utf-8", "surrogatepass")  # without the space put before the text

    def _bytes_of(self, ids: np.ndarray) -> bytes:
        size = self.size.take(ids)
        upto = size.cumsum()
        index = (self.start.take(ids) - upto + size).repeat(size)
        index += self.places[: len(index)]
        return self.flat.take(index).tobytes()


@lru_cache(maxsize=4)
def pieces(path: str, alpha: float = ALPHA) -> Pieces:
    return Pieces(path, alpha)


def chunks_of(text: str) -> list[str]:
    return CHUNKS.findall(" " + text)


class Lattices:
    """Backward sampling tables of distinct chunks.

    ``prob[p, l-1]``: probability, given a segmentation that reaches the end of
    row p's character, that its last piece has l characters; ``piece`` names
    it. The row of a chunk's j-th character is ``level[j] + rank``."""

    def __init__(self, vocab: Pieces, chunks: list[str]):
        lens = np.fromiter(map(len, chunks), np.int64, len(chunks))
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int32)
        codes[codes == SPACE] = LITERAL
        codes[codes == 32] = SPACE
        self.lens = lens
        begin = np.cumsum(lens) - lens
        n = len(codes)
        inside = np.arange(n, dtype=np.int32) - np.repeat(begin, lens).astype(np.int32)  # place in the chunk
        upcoming = np.append(inside, np.int32(-1))
        # Tables hold all first characters, then all second ones, and so on, the
        # longest chunks first, so that a step of the filter is one slice.
        order = np.argsort(-lens, kind="stable")
        longest = int(lens[order[0]]) if len(lens) else 0
        alive = np.searchsorted(-lens[order], -np.arange(longest), side="left")
        self.level = np.concatenate(([0], np.cumsum(alive)))  # first row of each place
        self.rank = np.empty(len(lens), dtype=np.int64)
        self.rank[order] = np.arange(len(lens))
        row = self.level[inside] + np.repeat(self.rank, lens)
        width = min(MOST_CHARS, int(lens.max())) if len(lens) else 1
        h = np.zeros(n, dtype=np.uint64)
        plus = codes.astype(np.uint64) + np.uint64(1)
        end = np.arange(n)  # of the substrings whose start is that of a piece
        places, names = [], []  # pieces by length: the row of their end, their ids
        for size in range(1, width + 1):
            # h: hash of the substring of this size to each end
            h = h * _HASH + plus[end]
            found, more = vocab.find(h)
            hit = np.flatnonzero(found >= 0)
            places.append(row[end[hit]])
            names.append(found[hit])
            longer = np.flatnonzero(more)
            end, h = end[longer] + 1, h[longer]
            keep = np.flatnonzero(upcoming[end] >= size)
            end, h = end[keep], h[keep]
            if not len(end):
                break
        width = max((i for i, ids in enumerate(names, 1) if len(ids)), default=1)
        self.piece = np.full((n, width), -1, dtype=np.int32)  # ending here, by length
        weight = np.zeros((n, width))
        for i in range(min(width, len(names))):
            self.piece[places[i], i] = names[i]
            weight[places[i], i] = vocab.weight[names[i]]
        # A character outside the vocabulary is an edge named by its code point.
        odd = np.flatnonzero(self.piece[:, 0] < 0)
        weight[odd, 0] = math.exp(vocab.fallback)
        by_row = np.empty(n, dtype=np.int32)
        by_row[row] = codes
        self.piece[odd, 0] = -1 - by_row[odd]
        # Forward filtering, place by place over all chunks at once.
        before = np.zeros((len(lens), width))  # sums at the last places, relative to the latest
        before[:, 0] = 1.0
        for j in range(longest):
            last = before[: alive[j]]
            part = weight[self.level[j] : self.level[j + 1]]
            part *= last
            total = part.sum(axis=1)[:, None]
            part /= total  # exactly 1 where there is one way
            last[:, 1:] = last[:, :-1] / total
            last[:, 0] = 1.0
        self.prob = weight
        self.best = weight.argmax(axis=1)
        self.top = weight[np.arange(n), self.best]

    def edges(self, rows: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Piece ids, or -1 - code point for a character outside the vocabulary."""
        return self.piece.reshape(-1).take(rows * self.piece.shape[1] + (size - 1))

    def sample(self, chunk: np.ndarray, seed: np.ndarray):
        """Draw a segmentation of each of ``chunk``. Returns (log_prob, count,
        steps): steps are (rows, edges, sizes), last pieces first."""
        rank = self.rank[chunk]
        end = self.lens[chunk] - 1  # place in the chunk where the next last piece ends
        log_prob = np.zeros(len(chunk))
        count = np.zeros(len(chunk), dtype=np.int64)
        steps = []
        rows = np.arange(len(chunk))
        step = 0
        while len(rows):
            u = _unit(seed + _times(step, _G2))
            # The likeliest last piece comes first; only draws beyond it look at the others.
            at = self.level[end] + rank
            size, p = self.best[at] + 1, self.top[at]
            past = np.flatnonzero(u >= p)
            if len(past):
                prob = self.prob[at[past]]
                every = np.arange(len(past))
                likeliest = size[past] - 1
                others = prob.copy()
                others[every, likeliest] = 0
                cum = np.cumsum(others, axis=1)
                goal = (u[past] - p[past]) / (1 - p[past]) * cum[:, -1]
                goal = np.minimum(goal, np.nextafter(cum[:, -1], 0))
                size[past] = (cum <= goal[:, None]).sum(axis=1) + 1
                p[past] = prob[every, size[past] - 1]
            steps.append((rows, self.edges(at, size), size))
            end = end - size
            step += 1
            more = np.flatnonzero(end >= 0)
            if step == 1:
                log_prob += np.log(p)
            else:
                log_prob[rows] += np.log(p)
            done = np.flatnonzero(end < 0)
            count[rows[done]] = step
            rows, end, rank, seed = rows[more], end[more], rank[more], seed[more]
        return log_prob, count, steps

    def rest(self, chunk: int, taken: list[tuple[int, ...]]):
        """Probability of avoiding the segmentations ``taken`` (sizes, last
        first) of a chunk, and the probability of each last piece of those
        that do; no term is the difference of nearly equal numbers."""
        rank = int(self.rank[chunk])
        # Places that the taken paths pass, each after the one that leads to it:
        # (end, paths that share it, their pieces so far).
        nodes, below = [(int(self.lens[chunk] - 1), list(range(len(taken))), 0)], []
        for end, shared, depth in nodes:
            inner: dict[int, int] = {}
            for i in shared:
                size = taken[i][depth]
                if depth + 1 == len(taken[i]):
                    inner[size] = -1  # the path itself, and nothing else
                elif size not in inner:
                    inner[size] = len(nodes)
                    nodes.append((end - size, [i], depth + 1))
                else:
                    nodes[inner[size]][1].append(i)
            below.append(inner)
        done: list = [None] * len(nodes)
        for at in range(len(nodes) - 1, -1, -1):
            left, total = [], 0.0
            for size, p in enumerate(self.prob[self.level[nodes[at][0]] + rank].tolist(), 1):
                if p > 0:
                    node, tree = below[at].get(size), None
                    if node is not None:
                        mass, tree = done[node] if node >= 0 else (0.0, None)
                        p *= mass
                    if p > 0:
                        left.append((size, p, tree))
                        total += p
            done[at] = (total, left)
        return done[0]

    def sample_rest(self, chunk: int, taken: list[tuple[int, ...]], seed: int):
        """(log_prob, edges, sizes), in text order, of a segmentation drawn
        among those not taken."""
        _, tree = self.rest(chunk, taken)
        rank, end = int(self.rank[chunk]), int(self.lens[chunk] - 1)
        log_prob, rows, sizes, step = 0.0, [], [], 0
        while end >= 0:
            row = int(self.level[end]) + rank
            u = _unit_of(seed + step * int(_G2))
            if tree is None:
                tree = [(s, p, None) for s, p in enumerate(self.prob[row].tolist(), 1) if p > 0]
            u *= sum(x[1] for x in tree)
            for size, p, inner in tree:
                u -= p
                if u < 0:
                    break
            log_prob += math.log(float(self.prob[row, size - 1]))
            rows.append(row)
            sizes.append(size)
            end, tree, step = end - size, inner, step + 1
        size = np.array(sizes[::-1], dtype=np.int64)
        return log_prob, self.edges(np.array(rows[::-1], dtype=np.int64), size), size


def _truncated(location: np.ndarray, cap, u: np.ndarray) -> np.ndarray:
    """Gumbels at ``location`` given that they are below ``cap``."""
    with np.errstate(divide="ignore"):
        return -np.logaddexp(-cap, np.log(-np.log(u)) - location)


class _Drawn:
    """A segmentation of one text: per chunk its log-probability, and the
    edges and sizes of its pieces with each chunk's offset among them."""

    def __init__(self, log_prob, offsets, edges, sizes):
        self.log_prob, self.offsets, self.edges, self.sizes = log_prob, offsets, edges, sizes

    def path(self, i: int) -> tuple[int, ...]:
        """Sizes of chunk i's pieces, last first."""
        return tuple(self.sizes[self.offsets[i] : self.offsets[i + 1]][::-1].tolist())


class _Known(defaultdict):
    """Chunk -> number; one asked for first gets the next number."""

    def __init__(self, chunks=()):
        super().__init__(None, zip(chunks, count()))
        self.kept = len(self)
        self.default_factory = count(self.kept).__next__

    def take_new(self) -> list[str]:
        """The chunks asked for first since the last call, which are forgotten."""
        new = list(islice(self, self.kept, None))  # in the order of their numbers
        for c in new:
            del self[c]
        self.default_factory = count(self.kept).__next__
        return new


class Frequent:
    """Lattices of the chunks met most often, kept by a worker process.

    The first ``NOTED_CHARS`` characters of text are only counted; then the
    chunks that came up in the most blocks, ``KEPT_CHARS`` characters of them,
    get lattices that later blocks share. What is drawn does not depend on it.
    """

    def __init__(self, vocab: Pieces):
        self.vocab, self.index, self.lattice = vocab, _Known(), None
        self.room, self.seen = NOTED_CHARS, Counter()

    def note(self, names: list[str], chars: int) -> None:
        if self.lattice is None:
            self.seen.update(names)
            self.room -= chars
            if self.room <= 0:
                names, room = [], KEPT_CHARS
                for c, times in self.seen.most_common():
                    room -= len(c)
                    if times < 2 or room < 0:
                        break
                    names.append(c)
                self.seen.clear()
                self.lattice = Lattices(self.vocab, names)
                self.index = _Known(names)


@lru_cache(maxsize=4)
def frequent(path: str, alpha: float) -> Frequent:
    return Frequent(pieces(path, alpha))


class _Block:
    """Some texts with the lattices of their distinct chunks: the frequent
    ones', which are shared, and the block's own. Beyond ``BLOCK_CHARS``
    characters of own chunks (one very long text) these are built group by
    group, each time they are needed."""

    def __init__(self, vocab: Pieces, texts: list[str], keys: list[int], common: Frequent | None = None):
        self.vocab = vocab
        known = common.index if common else _Known()
        shared = len(known)
        ids = []
        for t in texts:
            chunks = chunks_of(t) if t else ()
            ids.append(np.fromiter(map(known.__getitem__, chunks), np.int32, len(chunks)))
        self.first = [0, *np.cumsum([len(x) for x in ids]).tolist()]
        self.chunk = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        self.names = known.take_new()
        ends = np.cumsum(np.fromiter(map(len, self.names), np.int64, len(self.names)))
        cuts = [0]
        while len(ends) and ends[-1] - (ends[cuts[-1] - 1] if cuts[-1] else 0) > BLOCK_CHARS:
            done = ends[cuts[-1] - 1] if cuts[-1] else 0
            nxt = max(cuts[-1] + 1, int(np.searchsorted(ends, done + BLOCK_CHARS, side="right")))
            if nxt >= len(ends):
                break
            cuts.append(nxt)
        # (first number, end, lattices or None: to be built for each use)
        self.groups = [(0, shared, common.lattice)] if shared else []
        one = len(cuts) == 1
        for lo, hi in zip(cuts, [*cuts[1:], len(self.names)], strict=True):
            if hi > lo:
                self.groups.append((shared + lo, shared + hi, Lattices(vocab, self.names[lo:hi]) if one else None))
        if common:
            common.note(self.names, sum(map(len, texts)))
        self.shared = shared
        # Signed row keys to seeds.
        self.seed = _mix(np.array(keys, dtype=np.int64).view(np.uint64))
        self.base: dict[tuple[int, int], list[int]] = {}

    def lattice_of(self, chunk: int) -> tuple[Lattices, int]:
        for lo, hi, lattice in self.groups:
            if lo <= chunk < hi and lattice:
                return lattice, chunk - lo
        return Lattices(self.vocab, [self.names[chunk - self.shared]]), 0

    def key_of(self, text: int, place: int, sample: int, use: int) -> int:
        """``key`` of one chunk."""
        return self.bases(sample, use)[text] + place * int(_G1) & _ALL

    def bases(self, sample: int, use: int) -> list[int]:
        if (sample, use) not in self.base:
            shift = np.uint64(int(_times(sample + 1, _G3)) + int(_times(use + 1, _G2)) & _ALL)
            self.base[sample, use] = _mix(self.seed + shift).tolist()
        return self.base[sample, use]

    def uniform(self, text: np.ndarray, place: np.ndarray, sample: int, use: int) -> np.ndarray:
        return _unit(self.key(text, place, sample, use))

    def key(self, text, place, sample: int, use: int) -> np.ndarray:
        """64-bit counter of a text's chunk in a sample, for one use."""
        base = np.array(self.bases(sample, use), dtype=np.uint64)
        return base[text] + place.astype(np.uint64) * _G1  # mixed where a number is made of it

    def draw(self, tokens: np.ndarray, text: np.ndarray, sample: int):
        """Draw the chunks ``tokens`` of the texts ``text``: (log_prob, offsets,
        edges, sizes)."""
        place = tokens - np.array(self.first, dtype=np.int64)[text]
        seed = self.key(text, place, sample, 0)
        ids = self.chunk[tokens]
        log_prob, count, parts = np.zeros(len(ids)), np.zeros(len(ids), dtype=np.int64), []
        for lo, hi, lattice in self.groups:
            rows = np.flatnonzero((ids >= lo) & (ids < hi))
            if len(rows):
                lattice = lattice or Lattices(self.vocab, self.names[lo - self.shared : hi - self.shared])
                log_prob[rows], count[rows], steps = lattice.sample(ids[rows] - lo, seed[rows])
                parts.append((rows, steps))
        offsets = np.concatenate(([0], np.cumsum(count)))
        edges = np.zeros(offsets[-1], dtype=np.int32)
        sizes = np.zeros(offsets[-1], dtype=np.uint8)
        for rows, steps in parts:
            for i, (at, edge, size) in enumerate(steps):
                to = offsets[rows[at]] + count[rows[at]] - 1 - i
                edges[to] = edge
                sizes[to] = size
        return log_prob, offsets, edges, sizes


def _log_rest(log_prob: np.ndarray) -> np.ndarray:
    """log(1 - p) of log(p); a chunk with one segmentation has p = 1."""
    with np.errstate(divide="ignore"):
        return np.log(-np.expm1(log_prob))


def sample_block(
    vocab: Pieces, texts: list[str], keys: list[int], k: int = K, common: Frequent | None = None
) -> list[list[tuple]]:
    """For each text its samples, best first: (edges, log_prob, perturbed,
    inclusion)."""
    block = _Block(vocab, texts, keys, common)
    n = np.diff(block.first)
    every = np.arange(len(texts))
    owner = np.repeat(every, n)
    log_prob, offsets, edges, sizes = block.draw(np.arange(len(owner)), owner, 0)
    top = -np.log(-np.log(block.uniform(every, np.zeros(len(texts), dtype=np.int64), 0, 1)))
    ahead = np.cumsum(log_prob) - log_prob
    ahead -= np.repeat(ahead[np.minimum(block.first[:-1], max(len(ahead) - 1, 0))] if len(ahead) else np.zeros(len(texts)), n)
    place = np.arange(len(owner)) - np.repeat(np.array(block.first[:-1], dtype=np.int64), n)
    bound = _truncated(ahead + _log_rest(log_prob), np.repeat(top, n), block.uniform(owner, place, 0, 2))

    samples: list[list[_Drawn]] = []
    found: list[list[tuple[float, float]]] = []  # (log_prob, perturbed)
    agenda: list[list[tuple]] = []
    ticket = 0

    def push(heap, values: np.ndarray, chunks_from: int, base: int, drawn: _Drawn):
        """The best nodes that leave ``drawn`` at some chunk; k are enough."""
        nonlocal ticket
        best = np.argpartition(-values, k - 1)[:k] if len(values) > k else np.arange(len(values))
        for j in best.tolist():
            if values[j] > -np.inf:
                ticket += 1
                i = chunks_from + j
                left = -math.expm1(float(drawn.log_prob[i]))
                # None: what the node avoids is just the choice of ``drawn``
                heapq.heappush(heap, (-float(values[j]), ticket, base, i, None, left))

    for d in range(len(texts)):
        lo, hi = block.first[d], block.first[d + 1]
        a, b = offsets[lo], offsets[hi]
        drawn = _Drawn(log_prob[lo:hi], offsets[lo : hi + 1] - a, edges[a:b], sizes[a:b])
        samples.append([drawn])
        found.append([(float(drawn.log_prob.sum()), float(top[d]))])
        agenda.append([])
        push(agenda[-1], bound[lo:hi], 0, 0, drawn)

    for r in range(1, k):
        popped = [(d, heapq.heappop(h)) for d, h in enumerate(agenda) if h]
        if not popped:
            break
        tails = [np.arange(block.first[d] + node[3] + 1, block.first[d + 1]) for d, node in popped]
        sizes_of = np.array([len(t) for t in tails])
        tokens = np.concatenate(tails)
        text = np.repeat(np.array([d for d, _ in popped]), sizes_of)
        log_prob, offsets, edges, sizes = block.draw(tokens, text, r)
        place = tokens - np.array(block.first, dtype=np.int64)[text]
        noise = block.uniform(text, place, r, 2)
        rest = _log_rest(log_prob)
        at = np.concatenate(([0], np.cumsum(sizes_of)))
        for x, (d, (minus, _, base, i, taken, left)) in enumerate(popped):
            lo, hi = at[x], at[x + 1]
            before, cap = samples[d][base], -minus
            taken = taken or [before.path(i)]
            lattice, chunk = block.lattice_of(int(block.chunk[block.first[d] + i]))
            lp, edge, size = lattice.sample_rest(chunk, taken, block.key_of(d, i, r, 3))
            cut = before.offsets[i]
            a, b = offsets[lo], offsets[hi]
            new = _Drawn(
                np.concatenate((before.log_prob[:i], [lp], log_prob[lo:hi])),
                np.concatenate((before.offsets[: i + 1], [cut + len(edge)], offsets[lo + 1 : hi + 1] - a + cut + len(edge))),
                np.concatenate((before.edges[:cut], edge, edges[a:b])),
                np.concatenate((before.sizes[:cut], size.astype(np.uint8), sizes[a:b])),
            )
            samples[d].append(new)
            found[d].append((float(new.log_prob.sum()), cap))
            prefix = float(new.log_prob[:i].sum())
            taken = [*taken, new.path(i)]
            # What no choice has taken; summed anew where the difference is small.
            mass = left - math.exp(lp)
            if mass < 1e-6:
                mass, _ = lattice.rest(chunk, taken)
            if mass > 0:
                u = _unit_of(block.key_of(d, i, r, 4))
                value = -np.logaddexp(-cap, math.log(-math.log(u)) - prefix - math.log(mass))
                if value > -np.inf:
                    ticket += 1
                    heapq.heappush(agenda[d], (-float(value), ticket, len(samples[d]) - 1, i, taken, mass))
            ahead = prefix + lp + np.cumsum(log_prob[lo:hi]) - log_prob[lo:hi]
            push(agenda[d], _truncated(ahead + rest[lo:hi], cap, noise[lo:hi]), i + 1, len(samples[d]) - 1, new)

    out = []
    for d in range(len(texts)):
        threshold = -agenda[d][0][0] if agenda[d] else -math.inf
        rows = []
        for drawn, (lp, g) in zip(samples[d], found[d], strict=True):
            inclusion = 1.0 if threshold == -math.inf else -math.expm1(-math.exp(min(lp - threshold, 700.0)))
            rows.append((drawn.edges, lp, g, inclusion))
        out.append(rows)
    return out


def edge_ids(vocab: Pieces, edges: np.ndarray) -> np.ndarray:
    """Piece ids of edges; characters outside the vocabulary as byte pieces."""
    odd = np.flatnonzero(edges < 0)
    if not len(odd):
        return edges
    codes = -1 - edges[odd].astype(np.int64)
    if (codes < 128).all():
        out = edges.copy()
        out[odd] = vocab.byte_ids[codes]
        return out
    raw = [chr(SPACE if c == LITERAL else c).encode("utf-8", "surrogatepass") for c in codes.tolist()]
    count = np.ones(len(edges), dtype=np.int64)
    count[odd] = [len(b) for b in raw]
    out = np.repeat(edges, count)
    out[out < 0] = vocab.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)]
    return out


def _encode_batches(id_name: str, model: str, k: int, alpha: float):
    def rows_of(vocab, schema, ids, keys, texts):
        columns: list[list] = [[] for _ in range(7)]
        pieces_of, offsets = [], [0]
        for doc_id, key, text, samples in zip(
            ids, keys, texts, sample_block(vocab, texts, keys, k, frequent(model, alpha)), strict=True
        ):
            for r, (edges, lp, g, inclusion) in enumerate(samples):
                found = edge_ids(vocab, edges)
                pieces_of.append(found)
                offsets.append(offsets[-1] + len(found))
                for column, value in zip(
                    columns, (doc_id, key, r, lp, g, inclusion, vocab.decode(found) == text), strict=True
                ):
                    column.append(value)
        values = np.concatenate(pieces_of) if pieces_of else np.zeros(0, np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
        arrays = [pa.array(c, schema.field(i).type) for i, c in enumerate(columns)]
        return pa.RecordBatch.from_arrays([*arrays, lists.cast(schema.field(7).type)], schema=schema)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = pieces(model, alpha)
        for batch in batches:
            schema = pa.schema(
                [
                    pa.field(id_name, batch.schema.field(0).type),
                    pa.field("row_key", pa.int64()),
                    pa.field("sample", pa.int32()),
                    pa.field("log_prob", pa.float64()),
                    pa.field("perturbed", pa.float64()),
                    pa.field("inclusion", pa.float64()),
                    pa.field("round_trip", pa.bool_()),
                    pa.field("ids", pa.list_(pa.int32())),
                ]
            )
            at, room, cuts = 0, 0, []
            for i, n in enumerate(pc.utf8_length(batch.column(2)).to_pylist()):
                if room + n > BLOCK_CHARS and i > at:
                    cuts.append((at, i))
                    at, room = i, 0
                room += n
            if at < batch.num_rows:
                cuts.append((at, batch.num_rows))
            for lo, hi in cuts:  # only a block's rows are Python objects at a time
                yield rows_of(vocab, schema, *(c.to_pylist() for c in batch.slice(lo, hi - lo).columns[:3]))

    return of


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = K,
    alpha: float = ALPHA,
    model: str = MODEL,
) -> DataFrame:
    """(doc_id, row_key, sample, log_prob, perturbed, inclusion, round_trip,
    ids): for each row its ``k`` sampled segmentations, best first.

    ``model`` must be readable under this path on every executor."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        row_key(F.col(id_col), F.col(text_col)).alias("row_key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    schema = T.StructType(
        [
            T.StructField("doc_id", rows.schema["doc_id"].dataType),
            T.StructField("row_key", T.LongType()),
            T.StructField("sample", T.IntegerType()),
            T.StructField("log_prob", T.DoubleType()),
            T.StructField("perturbed", T.DoubleType()),
            T.StructField("inclusion", T.DoubleType()),
            T.StructField("round_trip", T.BooleanType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
        ]
    )
    return rows.mapInArrow(_encode_batches("doc_id", model, k, alpha), schema)


def decode(encoded: DataFrame, ids_col: str = "ids", out_col: str = "text", model: str = MODEL) -> DataFrame:
    """The input plus the text of its piece ids; null ids give null."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocab = pieces(model)
        for s in batches:
            yield pd.Series([None if x is None else vocab.decode(x) for x in s], dtype=object)

    return encoded.withColumn(out_col, texts(F.col(ids_col)))
