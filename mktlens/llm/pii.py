"""Personal data by patterns and a semi-Markov conditional random field.

Base finds (``email``, ``ip``, ``card``, ``phone``) are matches of four fixed
patterns and always stay. The model adds what is written in other ways: numbers
without a plus sign, cards with other separators, defanged addresses, mail
addresses spelt with (at) and dot.

* Where a text can hold an entity at all is a field: digits with what may stand
  between them, or a mail address in any spelling. Fields that touch make a
  region; outside regions every segment is no entity, so regions are decoded
  one by one with the same result as the whole text at once.
* A region is cut into tokens. Candidate segments are its runs of tokens within
  the bounds of an entity (``MOST_TOKENS``, ``MOST_DIGITS``, ``MOST_GROUPS``), each with features
  of the whole span: shape, groups of digits, check digit, octets, separators,
  spelling of the at sign, top-level domain, what stands before and after.
* The weights of features by kind, and of kind after kind, are learnt as a
  conditional random field over segmentations (numpy, Adam): exact gradients by
  forward and backward sums over segments. Decoding chooses boundaries and kinds
  together by the bounded-entity Viterbi recursion; a chosen segment is added if
  its marginal probability is at least ``SURE`` and no base find overlaps it.

Training text is a bounded sample of the documents themselves: base finds in
their surroundings, and other spellings of the values found (or of drawn ones),
as well as dates, versions, order numbers and other lookalikes, set between words
of the sample. At most ``SAMPLE`` texts of ``SAMPLE_BYTES`` bytes reach the driver;
the sample is the texts with the least id hashes, so the model does not depend
on file order.

Defined results: null and empty texts have no finds; repeated rows are judged
alike; null ids are kept; other columns are ignored, or kept by ``redact_pii``;
an empty table gives an empty result. Texts are read whole, however long, in time
proportional to their length. Places count code points, the end is exclusive.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mktlens.llm.sampling import least_hashes

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)  # the label of a token outside entities
SAMPLE = 400
SAMPLE_BYTES = 8_192
EXAMPLES = 2_400
EPOCHS = 12
BATCH = 32
RATE = 0.08
DECAY = 2e-4
SEED = 11
RARE = 4  # features met less often in training are left out
SURE = 0.9
MOST_TOKENS = 24
MOST_DIGITS = 19
MOST_GROUPS = 6
MOST_LOCAL = 64  # characters of the part before the at sign
WINDOW, MARGIN = 4_096, 512  # characters

# ------------------------------------------------------------ base finds

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def base_finds(text: str | None) -> list[tuple[int, int, int]]:
    """(start, rank, end), sorted. A leftmost match of the mail pattern starts at
    the first character before an at sign that can belong to it, so every at
    sign is looked at once."""
    if not text:
        return []
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _NO_DIGIT.sub("", m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_NO_DIGIT.sub("", m[0])) <= 15]
    return sorted(found)


# ------------------------------------------------------------ regions and segments

# Digits and what may stand between them: at most three signs at a time.
_NUMBER = re.compile(r"(?:[+(]{1,2})?[0-9]++(?:[ ().\[\]/_+-]{1,4}[0-9]++)*+")
_AT = re.compile(r"@|[ ]?[\[({<] ?(?:at|AT) ?[\])}>] ?| (?:at|AT) ")
_REST = re.compile(
    r" ?[A-Za-z0-9-]{1,63}(?:(?:\.| \. |[ ]?[\[({<] ?(?:dot|DOT|\.) ?[\])}>] ?| (?:dot|DOT) )[A-Za-z0-9-]{1,63}(?![A-Za-z0-9-]))+"
)
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|[^0-9A-Za-z]")
_WORD_BEFORE = re.compile(r"([A-Za-zÀ-ɏ]{1,15})[^A-Za-zÀ-ɏ0-9]{0,3}\Z")


def _fields(text: str) -> list[tuple[int, int]]:
    """Places that can hold an entity."""
    out = []
    if _DIGIT.search(text):
        for m in _NUMBER.finditer(text):
            if m.end() - m.start() > 6:
                out.append(m.span())
    if "@" in text or "at" in text or "AT" in text:
        for m in _AT.finditer(text):
            end = _REST.match(text, m.end())
            start = m.start() - (text[m.start() - 1 : m.start()] == " " and m[0] == "@")
            least = max(0, start - MOST_LOCAL)
            first = start
            while first > least and text[first - 1] in _LOCAL:
                first -= 1
            if end and first < start:
                out.append((first, end.end()))
    return sorted(out)


def regions(text: str) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in _fields(text):
        if out and a < out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _class(c: str) -> str:
    if not c:
        return "edge"
    if c.isdigit():
        return "digit"
    if c.isalpha():
        return "letter"
    return "blank" if c.isspace() else c


def _around(text: str, a: int, b: int) -> list[str]:
    left, right = text[a - 1 : a], text[b : b + 1]
    out = [f"left {_class(left)}", f"right {_class(right)}"]
    if right and not right.isalnum() and text[b + 1 : b + 2].isdigit():
        out.append(f"digit after {right}")
    if left and not left.isalnum() and text[a - 2 : a - 1].isdigit():
        out.append(f"digit before {left}")
    word = _WORD_BEFORE.search(text, max(0, a - 19), a)
    if word:
        out.append(f"word {word[1].lower()}")
    return out


def _number_features(s: str) -> list[str]:
    groups = re.findall("[0-9]+", s)
    digits = "".join(groups)
    seps = re.findall("[^0-9]+", s.lstrip("+("))
    sizes = ",".join(str(len(g)) for g in groups)
    n = len(digits)
    out = [f"digits {n}", f"groups {sizes}", f"between {'|'.join(sorted(set(seps)))}", f"count {len(groups)}"]
    out.append(f"shape {re.sub('[0-9]', '9', s)}")
    lead = s[0] if s[0] in "+(" else "00" if s.startswith("00") else "0" if s[0] == "0" else "digit"
    out += [f"lead {lead}", f"lead {lead} digits {n}", "one separator" if len(set(seps)) < 2 else "many separators"]
    if s.count("(") != s.count(")"):
        out.append("open bracket")
    if n >= 13:
        out += [f"check digit {luhn(digits)}", f"first {digits[0]}", f"check digit {luhn(digits)} {min(n, 20)}"]
    if len(groups) == 4:
        fits = all(_octet(g) and (g == "0" or g[0] != "0") for g in groups)
        out += [f"octets {fits}", f"octets {fits} {'|'.join(sorted(set(seps)))}"]
    if groups and len(groups[0]) == 4 and groups[0][:2] in ("19", "20"):
        out.append("a year first")
    if groups and len(groups[-1]) == 4 and groups[-1][:2] in ("19", "20"):
        out.append("a year last")
    return out


def _mail_features(s: str, at: re.Match) -> list[str]:
    local, domain = s[: at.start()], s[at.end() :]
    dots = re.findall(r"(?i) ?[\[({<] ?(?:dot|\.) ?[\])}>] ?| dot | \. |\.", domain)
    last = re.split(r"[^A-Za-z0-9-]+", domain)[-1]
    spelt = re.sub("[A-Za-z]", "a", at[0].strip()) if len(at[0].strip()) > 1 else at[0].strip()
    kinds = "|".join(sorted({d.strip().lower() for d in dots}))
    out = [f"at {spelt}", f"dots {kinds}", f"at {spelt} dots {kinds}", f"labels {min(len(dots), 4)}"]
    out += [f"last {'letters' if last.isalpha() else 'digits' if last.isdigit() else 'mixed'} {min(len(last), 7)}"]
    out += [f"local {'digits' if local.isdigit() else 'letters' if local.isalpha() else 'mixed'}"]
    out.append("local ends with a dot" if local.strip().endswith((".", "-")) else "local ends well")
    return out


@dataclass
class Region:
    """Tokens (their places) and candidate segments: (first token, token after
    the last, kinds that it may be, features)."""

    places: list[int]
    segments: list[tuple[int, int, tuple[int, ...], list[str]]] = field(default_factory=list)


def _number_kinds(s: str, digits: int, groups: int) -> tuple[int, ...]:
    """What digits in groups can be at all."""
    kinds = (1,) if groups == 4 and digits <= 12 and s.count(".") == 3 else ()
    if 12 <= digits <= 19:
        kinds += (2,)
    return kinds + (3,) if 7 <= digits <= 15 else kinds


def segments(text: str, a: int, b: int) -> Region:
    tokens = [m.span() for m in _TOKEN.finditer(text, a, b)]
    places = [s for s, _ in tokens] + [b]
    out = Region(places)
    first = [text[s] for s, _ in tokens]
    mail = any(c == "@" for c in first) or any(text[s:e] in ("at", "AT") for s, e in tokens)
    for i, c in enumerate(first):
        is_digit = "0" <= c <= "9"
        if not (is_digit or c in "+(" or (mail and c in _LOCAL)):
            continue
        n = groups = 0
        for j in range(i, min(len(tokens), i + MOST_TOKENS) if is_digit or c in "+(" else i):
            d = first[j]
            if "0" <= d <= "9":
                groups, n = groups + 1, n + tokens[j][1] - tokens[j][0]
                if n > MOST_DIGITS or groups > MOST_GROUPS:
                    break
                s = text[places[i] : tokens[j][1]]
                kinds = _number_kinds(s, n, groups)
                if kinds:
                    out.segments.append((i, j + 1, kinds, _number_features(s) + _around(text, places[i], tokens[j][1])))
            elif d.isalpha() or d == "@":
                break
        if mail and c in _LOCAL:
            size = min(len(tokens), i + MOST_TOKENS)
            end = tokens[size - 1][1]
            at = _AT.search(text, places[i], end)
            if at and 0 < at.start() - places[i] <= MOST_LOCAL and all(x in _LOCAL or x == " " for x in text[places[i] : at.start()]):
                for j in range(i + 2, size):
                    if tokens[j][0] > at.end() and first[j].isalnum():
                        s = text[places[i] : tokens[j][1]]
                        m = _AT.search(s)
                        if m and m.end() < len(s):
                            out.segments.append((i, j + 1, (0,), _mail_features(s, m) + _around(text, places[i], tokens[j][1])))
    return out


# ------------------------------------------------------------ the model


def _log_sum(xs: list[float]) -> float:
    top = max(xs)
    return top + math.log(sum(math.exp(x - top) for x in xs)) if top > -math.inf else top


def _outside(r: Region) -> list[list[tuple[int, int, float]]]:
    """Segments by the place where they end: so far each token by itself."""
    return [[(j - 1, NONE, 0.0)] if j else [] for j in range(len(r.places))]


@dataclass
class SemiCrf:
    """``weights`` by feature, one for each kind; ``follow[x][y]``: label y after
    label x. A token outside entities scores nothing by itself."""

    weights: dict[str, tuple[float, ...]]
    follow: np.ndarray

    def scored(self, r: Region) -> list[list[tuple[int, int, float]]]:
        """For each place the segments that end there: (first token, label, score)."""
        ending = _outside(r)
        for i, j, kinds, feats in r.segments:
            known = [w for f in feats if (w := self.weights.get(f))]
            ending[j] += [(i, k, sum([w[k] for w in known])) for k in kinds]
        return ending

    def best(self, ending: list[list[tuple[int, int, float]]]) -> list[tuple[int, int, int]]:
        """The likeliest segmentation: its entities as (first, after, kind)."""
        follow = self.follow.tolist()
        value = [[-math.inf] * (NONE + 1) for _ in ending]
        back: list[list[tuple[int, int] | None]] = [[None] * (NONE + 1) for _ in ending]
        value[0][NONE] = 0.0
        for j in range(1, len(ending)):
            for i, k, score in ending[j]:
                for x, v in enumerate(value[i]):
                    if v + follow[x][k] + score > value[j][k]:
                        value[j][k] = v + follow[x][k] + score
                        back[j][k] = (i, x)
        out, j = [], len(ending) - 1
        k = max(range(NONE + 1), key=lambda x: value[j][x])
        while j > 0:
            i, x = back[j][k]
            if k != NONE:
                out.append((i, j, k))
            j, k = i, x
        return out[::-1]

    def sums(self, ending: list[list[tuple[int, int, float]]]):
        """Forward and backward sums, in logarithms, by place and last label."""
        follow = self.follow.tolist()
        labels = range(NONE + 1)
        ahead = [[-math.inf] * (NONE + 1) for _ in ending]
        ahead[0][NONE] = 0.0
        for j in range(1, len(ending)):
            by: list[list[float]] = [[] for _ in labels]
            for i, k, score in ending[j]:
                by[k] += [v + follow[x][k] + score for x, v in enumerate(ahead[i]) if v > -math.inf]
            ahead[j] = [_log_sum(b) if b else -math.inf for b in by]
        behind: list[list[list[float]]] = [[[] for _ in labels] for _ in ending]
        done = [[0.0] * (NONE + 1) for _ in ending]
        for j in range(len(ending) - 1, 0, -1):
            if j < len(ending) - 1:
                done[j] = [_log_sum(b) if b else -math.inf for b in behind[j]]
            for i, k, score in ending[j]:
                for x in labels:
                    behind[i][x].append(follow[x][k] + score + done[j][k])
        return ahead, done, _log_sum(ahead[-1])

    def marginals(self, ending: list[list[tuple[int, int, float]]]):
        """(first, after, label before, label, probability) of every way to use a segment."""
        ahead, done, whole = self.sums(ending)
        follow = self.follow.tolist()
        for j in range(1, len(ending)):
            for i, k, score in ending[j]:
                for x, v in enumerate(ahead[i]):
                    if v > -math.inf and done[j][k] > -math.inf:
                        yield i, j, x, k, math.exp(v + follow[x][k] + score + done[j][k] - whole)

    def decode(self, text: str, a: int, b: int) -> Iterator[tuple[int, int, int, float]]:
        """Entities of a region: (start, end, kind, probability). A region of
        over ``WINDOW`` characters is decoded piece by piece, each seen with
        ``MARGIN`` characters of its neighbours, more than an entity has."""
        done = a
        for lo in range(a, b, WINDOW):
            hi = min(b, lo + WINDOW)
            r = segments(text, max(a, lo - MARGIN), min(b, hi + MARGIN))
            if not r.segments:
                continue
            ending = self.scored(r)
            chosen = self.best(ending)
            p: dict[tuple[int, int, int], float] = Counter()
            for i, j, _, k, q in self.marginals(ending) if chosen else ():
                p[i, j, k] += q
            for i, j, k in chosen:
                start, end = r.places[i], r.places[j]
                if lo <= start < hi and start >= done:
                    yield start, end, k, min(1.0, p[i, j, k])
                    done = end


def fit(examples: list[tuple[str, list[tuple[int, int, int]]]], epochs: int = EPOCHS) -> SemiCrf:
    """Learns from texts with their entities (start, end, kind)."""
    data = []
    seen: Counter[str] = Counter()
    for text, gold in examples:
        for a, b in regions(text):
            r = segments(text, a, b)
            at = {p: i for i, p in enumerate(r.places)}
            inside = [(at.get(s), at.get(e), k) for s, e, k in gold if s < b and e > a]
            known = {(i, j): kinds for i, j, kinds, _ in r.segments}
            if r.segments and all((i, j) in known and k in known[i, j] for i, j, k in inside):
                data.append((r, inside))
                seen.update({f for *_, feats in r.segments for f in feats})
    names = {f: n for n, f in enumerate(sorted(f for f, n in seen.items() if n >= RARE))}
    w = np.zeros((len(names), len(KINDS)))
    follow = np.zeros((NONE + 1, NONE + 1))
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, follow)]
    ids = [[np.array([names[f] for f in feats if f in names], dtype=np.int64) for *_, feats in r.segments] for r, _ in data]
    rng, step = random.Random(SEED), 0
    for _ in range(epochs):
        order = list(range(len(data)))
        rng.shuffle(order)
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            g_w, g_f = -DECAY * len(some) * w, -DECAY * len(some) * follow
            model = SemiCrf({}, follow)
            for n in some:
                _gradient(model, *data[n], ids[n], w, g_w, g_f)
            step += 1
            for x, g, m in ((w, g_w, moments[0]), (follow, g_f, moments[1])):
                m[0] += 0.1 * (g - m[0])
                m[1] += 0.01 * (g * g - m[1])
                x += RATE * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-6)
    return SemiCrf({f: tuple(w[n].tolist()) for f, n in names.items()}, follow)


def _gradient(model: SemiCrf, r: Region, gold, ids, w, g_w, g_f) -> None:
    """Adds the gradient of one region's log-likelihood."""
    ending, place = _outside(r), {}
    for (i, j, kinds, _), at in zip(r.segments, ids, strict=True):
        total = w[at].sum(axis=0)
        place[i, j, kinds] = at
        ending[j] += [(i, k, float(total[k])) for k in kinds]
    of = {(i, j, k): at for (i, j, kinds), at in place.items() for k in kinds}
    for i, j, x, k, q in model.marginals(ending):
        g_f[x, k] -= q
        if k != NONE and q > 1e-9:
            np.add.at(g_w[:, k], of[i, j, k], -q)
    at, label = 0, NONE
    for i, j, k in sorted(gold):
        for _ in range(at, i):
            g_f[label, NONE] += 1
            label = NONE
        g_f[label, k] += 1
        np.add.at(g_w[:, k], of[i, j, k], 1.0)
        at, label = j, k
    for _ in range(at, len(r.places) - 1):
        g_f[label, NONE] += 1
        label = NONE


# ------------------------------------------------------------ training examples

CUES = {
    0: ("mail", "email", "contact", "write to", "", "", ""),
    1: ("ip", "host", "address", "from", "", "", ""),
    2: ("card", "visa", "paid with", "number", "", "", ""),
    3: ("tel", "phone", "call", "fax", "mobile", "", "", ""),
    NONE: ("version", "order", "no", "id", "isbn", "invoice", "v", "total", "date", "", "", ""),
}


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _card(rng: random.Random, valid: bool) -> str:
    body = rng.choice("3456") + _digits(rng, rng.choice((12, 14, 14, 14, 14, 15, 17)))
    check = next(c for c in "0123456789" if luhn(body + c))
    return body + (check if valid else rng.choice([c for c in "0123456789" if c != check]))


def _grouped(s: str, sep: str) -> str:
    return sep.join(s[i : i + 4] for i in range(0, len(s), 4))


def _mail(rng: random.Random, value: str) -> str:
    local, _, domain = value.partition("@")
    at = rng.choice(("@", " (at) ", "(at)", " [at] ", "[at]", " at ", " AT ", " @ "))
    dots = [".", " dot ", " (dot) ", "[dot]", "[.]", " DOT "]
    dot = rng.choice(dots if at not in ("@", " at ", " AT ") else dots[1:] if at != "@" else dots[:1])
    return local + at + domain.replace(".", dot)


def _phone(rng: random.Random) -> str:
    a, b, c = rng.choice("23456789") + _digits(rng, 2), rng.choice("23456789") + _digits(rng, 2), _digits(rng, 4)
    d = _digits(rng, rng.choice((7, 8)))
    cc = rng.choice(("1", "44", "49", "33", "34"))
    return rng.choice(
        (
            f"({a}) {b}-{c}", f"({a}){b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"1-{a}-{b}-{c}", f"1 {a} {b} {c}",
            f"1 ({a}) {b}-{c}", f"+{cc} ({a}) {b}-{c}", f"+{cc} {a} {b} {c}", f"+{cc}-{a}-{b}-{c}", f"00{cc} {a} {b} {c}",
            f"00{cc}-{a}-{d}", f"+{cc} {d[:2]} {d[2:]}{c[:2]}", f"0{d[:2]} {d[2:]} {c}", f"0{a}/{d}", f"+{cc}/{a}/{d}",
        )
    )


def _lookalike(rng: random.Random) -> str:
    n = lambda k: _digits(rng, k)
    r = lambda a, b: str(rng.randint(a, b))
    y, m, d = r(1900, 2099), f"{rng.randint(1, 12):02}", f"{rng.randint(1, 28):02}"
    return rng.choice(
        (
            f"{y}-{m}-{d}", f"{d}.{m}.{y}", f"{m}/{d}/{y}", f"{y}{m}{d}", f"{y}-{r(1900, 2099)}", f"{d}-{m}-{y} {n(2)}",
            f"{r(0, 20)}.{r(0, 30)}.{r(0, 99)}", f"{r(0, 9)}.{r(0, 9)}.{r(0, 9)}.{r(0, 9)}.{r(0, 9)}",
            f"{r(256, 999)}.{r(0, 999)}.{r(256, 999)}.{r(0, 99)}", f"{r(1, 99)}.{n(rng.randint(3, 9))}", n(rng.randint(4, 12)),
            _card(rng, False), _card(rng, False), _grouped(_card(rng, False), " "), _grouped(_card(rng, False), "-"), n(20) + n(5),
            f"978-{r(0, 9)}-{n(2)}-{n(6)}-{r(0, 9)}", f"{n(5)}-{n(4)}", f"{n(3)}-{n(2)}-{n(4)}", f"{r(1, 9)} {n(3)} {n(3)}",
            f"{r(1, 99)} {r(1, 99)} {r(1, 99)} {r(1, 99)} {r(1, 99)}", f"{r(-90, 90)}.{n(4)} {r(-90, 90)}.{n(4)}", f"{r(1, 99)},{n(3)}.{n(2)}",
            f"{n(4)}/{n(4)}", f"{n(2)}-{n(3)}", f"({n(4)}) {n(3)}", f"[{r(1, 99)}] [{r(1, 99)}]", f"{n(6)}-{n(6)}-{n(6)}",
            f"at example.{rng.choice(('com', 'org', 'net'))}", f"a @ {r(1, 99)}.{n(2)}", f"look at page.{r(1, 99)}", f"met at noon.{r(1, 9)}",
        )
    )


def examples(texts: list[str], many: int = EXAMPLES, seed: int = SEED) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Texts with their entities: base finds where they stand, and ``many`` drawn
    ones, a third of them lookalikes, between words of the texts."""
    rng = random.Random(seed)
    out, words, values = [], [], {k: [] for k in range(NONE)}
    for t in texts:
        finds = base_finds(t)
        for i, (a, k, b) in enumerate(finds):
            if len(values[k]) < many and (i == 0 or finds[i - 1][2] <= a) and (i + 1 == len(finds) or finds[i + 1][0] >= b):
                values[k].append(t[a:b])
                lo, hi = max(0, a - 40), b + 40
                others = [f for f in finds if f != (a, k, b) and f[0] < hi and f[2] > lo]
                if not others:
                    out.append((t[lo:hi], [(a - lo, b - lo, k)]))
        words += [w for w in t.split() if not any(c in w for c in "0123456789@+")][:200]
    out = rng.sample(out, many // 4) if len(out) > many // 4 else out
    words = words or ["text"]
    for _ in range(many):
        k = rng.choice((0, 1, 2, 3, NONE, NONE, NONE))
        if k == 0:
            host = f"{rng.choice(words)[:9]}{rng.choice(('', '.mail', '-x'))}.{rng.choice(('com', 'org', 'de', 'net', 'info', 'fr'))}"
            plain = re.sub("[^a-z0-9.-]", "", host.lower())
            drawn = re.sub("[^a-z0-9.]", "", rng.choice(words).lower())[:12] or "user"
            value = rng.choice(values[0]) if values[0] and rng.random() < 0.5 else f"{drawn}{rng.choice(('', '.7', '42'))}@a{plain}"
            s = _mail(rng, value)
        elif k == 1:
            octets = [str(rng.randint(0, 255)) for _ in range(4)]
            parts = rng.choice(values[1]).split(".") if values[1] and rng.random() < 0.5 else octets
            s = rng.choice((".", ".", "[.]", "(.)", " . ", "[.]")).join(parts)
        elif k == 2:
            drawn = _card(rng, True)
            digits = _NO_DIGIT.sub("", rng.choice(values[2])) if values[2] and rng.random() < 0.5 else drawn
            s = rng.choice((digits, digits, *(_grouped(digits, c) for c in (" ", "-", ".", "/", "_", "  "))))
        else:
            s = _phone(rng) if k == 3 else _lookalike(rng)
        cue = rng.choice(CUES[k])
        left = " ".join(rng.choice(words) for _ in range(3)) + " " + (cue + rng.choice((" ", ": ", " ")) if cue else "")
        right = rng.choice((" ", ", ", ". ", ") ", "\n")) + " ".join(rng.choice(words) for _ in range(3))
        out.append((left + s + right, [] if k == NONE else [(len(left), len(left) + len(s), k)]))
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> SemiCrf:
    """The model, from a bounded sample of the documents."""
    short = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("t")).where(
        F.octet_length("t") <= SAMPLE_BYTES
    )
    n = short.agg(F.count("*").alias("n")).first()["n"]
    rows = least_hashes(short, F.concat_ws(":", "id", "t"), n, SAMPLE).collect()
    return fit(examples(sorted(r["t"] for r in rows)))


# ------------------------------------------------------------ over documents


def all_finds(text: str | None, model: SemiCrf) -> list[tuple[int, int, int, bool, float]]:
    """(start, rank, end, base, probability), sorted."""
    if not text:
        return []
    base = base_finds(text)
    out = [(a, k, b, True, 1.0) for a, k, b in base]
    taken = _union([(a, b) for a, _, b in base])
    for a, b in regions(text):
        if not _covered(taken, a, b):
            out += [(s, k, e, False, p) for s, e, k, p in model.decode(text, a, b) if p >= SURE and not _overlaps(taken, s, e)]
    return sorted(out)


def _union(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    starts: list[int] = []
    ends: list[int] = []
    for a, b in sorted(spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def _overlaps(taken: tuple[list[int], list[int]], a: int, b: int) -> bool:
    at = bisect_right(taken[1], a)
    return at < len(taken[0]) and taken[0][at] < b


def _covered(taken: tuple[list[int], list[int]], a: int, b: int) -> bool:
    at = bisect_right(taken[0], a) - 1
    return at >= 0 and taken[1][at] >= b


FINDS = "array<struct<start:bigint,rank:int,kind:string,end:bigint,base:boolean,probability:double>>"
_ARROW_FINDS = pa.list_(
    pa.struct(
        [
            ("start", pa.int64()),
            ("rank", pa.int32()),
            ("kind", pa.string()),
            ("end", pa.int64()),
            ("base", pa.bool_()),
            ("probability", pa.float64()),
        ]
    )
)


def finds_udf(model: SemiCrf):
    @F.arrow_udf(FINDS)
    def of(texts: pa.Array) -> pa.Array:
        rows = [
            [{"start": a, "rank": k, "kind": KINDS[k], "end": b, "base": own, "probability": p} for a, k, b, own, p in all_finds(t, model)]
            for t in texts.to_pylist()
        ]
        return pa.array(rows, _ARROW_FINDS)

    return of


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: SemiCrf | None = None) -> DataFrame:
    """(doc_id, finds) of every row: the sorted array of (start, rank, kind, end,
    base, probability); rank is the kind's place in ``KINDS``."""
    model = model or train(docs, id_col, text_col)
    return docs.select(F.col(id_col).alias("doc_id"), finds_udf(model)(F.col(text_col).cast("string")).alias("finds"))


def spans_text(finds: Column) -> Column:
    return F.array_join(
        F.transform(finds, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def redact_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: SemiCrf | None = None) -> DataFrame:
    """All rows and columns of the input; each run of finds that overlap is
    replaced by the first one's kind in brackets."""
    model = model or train(docs, id_col, text_col)

    @F.arrow_udf("string")
    def masked(texts: pa.Array) -> pa.Array:
        return pa.array([redacted(t, all_finds(t, model)) for t in texts.to_pylist()], pa.string())

    return docs.select(*[masked(F.col(c).cast("string")).alias(c) if c == text_col else F.col(c) for c in docs.columns])


def redacted(text: str | None, finds: list[tuple]) -> str | None:
    if not finds:
        return text
    parts, at = [], 0
    for a, k, b, *_ in finds:
        if a >= at:
            parts += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*parts, text[at:]])
