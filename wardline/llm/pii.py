"""Personal data in texts: plain patterns, and boosted trees over many candidates.

High-recall generators propose overlapping spans: every stretch of neighbouring digit
groups, and every reading of something as an address, disguised or not.  Gradient
boosted trees, one model a kind, judge a candidate by its format and by what stands
around it; thresholds calibrated on held-out texts select the spans that are added to
those of the plain patterns.  The trees learn from the plain patterns' own verified
matches in all texts: as they stand, run into one another, disguised, and spoilt.
Examples are counted by the bins of their features, and a level of the trees is one
pass over those counts in tasks; sums are whole numbers, so that neither the order of
rows nor their number in a task changes a tree.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate, islice
from random import Random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm.common import chunks, discard, fresh, in_arrow, store

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

#: The share of the texts that only calibrates (one in so many).
HELD_OUT = 4
#: What share of the selected candidates of the held-out texts must be right.
PRECISION = 0.97
#: Different examples up to which the driver grows the trees, with the same result as tasks.
LOCAL = 1 << 17
#: Rounds after which margins are written, and the rows that a task adds up at once.
STORED, ROWS = 8, 1 << 17
#: Units of a sum of gradients, and of a threshold.
UNIT, CELLS = 1 << 24, 1 << 12

# ------------------------------------------------------------ plain patterns

# Written so that no text takes more than linear time; a run is read once.
_LOCAL, _DOMAIN = "[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_EMAIL_HERE = re.compile(f"{_LOCAL}++@{_DOMAIN}")
_EMAIL = re.compile(f"(?<!{_LOCAL}){_LOCAL}++@{_DOMAIN}")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while m := _EMAIL_HERE.match(text, at) or _EMAIL.search(text, at):
        yield m.span()
        at = m.end()


def verified(kind: int, span: str) -> bool:
    """Whether what a kind's pattern matched is one."""
    if kind == IP:
        return all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in span.split("."))
    digits = _NOT_DIGIT.sub("", span) if kind != EMAIL else ""
    if kind == CARD:
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == EMAIL or 9 <= len(digits) <= 15


def matches(text: str) -> list[tuple[int, int, int, bool]]:
    """(start, end, kind, verified): all matches of the patterns, in order."""
    out = []
    if "@" in text:
        out += [(s, e, EMAIL, True) for s, e in _emails(text)]
    for kind, pattern in ((IP, _IP), (CARD, _CARD), (PHONE, _PHONE)):
        if kind != PHONE or "+" in text:
            out += [(*m.span(), kind, verified(kind, m[0])) for m in pattern.finditer(text)]
    return sorted(out, key=lambda x: (x[0], x[2]))


# --------------------------------------------------------------- candidates

_OPEN, _CLOSE = r" ?[\[({<] ?", r" ?[\])}>] ?"
_DOT = rf"(?:{_OPEN}(?:dot|\.){_CLOSE}|\ dot\ |\.)".replace(r"\ ", " ")
_AT = rf"(?: ?@ ?|{_OPEN}(?:at|@){_CLOSE}| at )"
_ADDRESS = re.compile(rf"(?i)({_AT})([a-z0-9-]{{1,63}}(?:{_DOT}[a-z0-9-]{{1,63}})+)")
_DOTS = re.compile(rf"(?i){_DOT}")
_BEFORE = re.compile(f"{_LOCAL}{{1,64}}\\Z")
_BETWEEN = rf"(?:{_OPEN}(?:\.|dot){_CLOSE}| dot | ?[.,:/-] ?| ?\(|\) ?-?| {{1,2}})"
_CHAIN = re.compile(rf"[0-9]+(?:{_BETWEEN}[0-9]+)*")
_DIGITS = re.compile("[0-9]+")
#: Bytes that a text with candidates has; without one of them it has none.
_HINTS = np.zeros(256, bool)
_HINTS[list(b"0123456789@[({<")] = True


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of everything that might be one; they overlap."""
    out = []
    for m in _ADDRESS.finditer(text):
        before = _BEFORE.search(text[max(0, m.start() - 64):m.start()])
        if before:
            start, first = m.start() - len(before[0]), m.start(2)
            dots = [d for d in _DOTS.finditer(text, first, m.end())]
            ends = [d.start() for d in dots[1:]] + [m.end()]
            out += [(start, e, EMAIL) for e in ends[-4:]]
    for m in _CHAIN.finditer(text):
        groups = [g.span() for g in _DIGITS.finditer(text, m.start(), m.end())]
        for i, (s, _) in enumerate(groups):
            total = 0
            lead = s - 1 if s and text[s - 1] in "+(" else s
            if lead < s and lead and text[lead] == "(" and text[lead - 1] == "+":
                lead -= 1
            for j in range(i, len(groups)):
                total += groups[j][1] - groups[j][0]
                if total > 19:
                    break
                e = groups[j][1]
                if total >= 12:
                    out.append((s, e, CARD))
                if 7 <= total <= 15 and (lead < s or j > i):
                    out.append((lead, e, PHONE))
                if j - i == 3 and total <= 12:
                    out.append((s, e, IP))
    return out


# ----------------------------------------------------------------- features

_KIND_OF = {**{c: 1 for c in " \t\n\r\f\v\xa0"}, ".": 4, **{c: 5 for c in ",;:!?"}, **{c: 6 for c in "\"'()[]{}<>"}, "-": 7}


def _around(text: str, at: int) -> int:
    """The kind of character at a place: 0 outside of the text."""
    if not 0 <= at < len(text):
        return 0
    c = text[at]
    return _KIND_OF.get(c) or (3 if c in "0123456789" else 2 if c.isalpha() else 8)


FEATURES = 31


def features(text: str, s: int, e: int, kind: int) -> list[float]:
    """Format of a candidate, and what stands around it."""
    span = text[s:e]
    groups = _DIGITS.findall(span)
    sizes = [len(g) for g in groups] or [0]
    digits = "".join(groups)
    between = {x for x in _NOT_DIGIT.findall(span.lstrip("+(")) if x}
    before, after = text[max(0, s - 12):s], text[e:e + 12]
    near = text[max(0, s - 3):s]
    low = span.lower()
    at = re.search(_AT, low) if kind == EMAIL else None
    domain = low[at.end():] if at else ""
    labels = _DOTS.split(domain) if domain else []
    return [
        e - s, len(digits), sum(c.isalpha() for c in span), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1],
        int(digits[0]) if digits else -1, span[0] == "+", "(" in span, len(between), luhn(digits) if len(digits) > 1 else 0,
        max((min(int(g[-9:]), 1000) if len(g) < 10 else 1000 for g in groups), default=0), span.count(" "),
        _around(text, s - 1), _around(text, e), _around(text, s - 2), _around(text, e + 1),
        sum(c in "0123456789" for c in before), sum(c in "0123456789" for c in after),
        _around(text, s - 2) == 3 and _around(text, s - 1) != 2, _around(text, e + 1) == 3 and _around(text, e) != 2,
        len(labels), len(labels[-1]) if labels else 0, 0 if "@" in span else 1 if at and any(c in "[({<" for c in at[0]) else 2,
        len(set(_DOTS.findall(domain)) - {"."}) if domain else 0, sum(c.isalpha() for c in text[max(0, s - 3):s] + text[e:e + 3]),
        any(c in "=\"':#" for c in near), span.count("."), sizes[1] if len(sizes) > 1 else 0,
    ]


# -------------------------------------------------------------------- trees


@dataclass
class Trees:
    """Gradient boosted trees of equal depth for a yes or no."""
    start: float = -20.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # feature, threshold, value of a leaf

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, threshold, value in self.trees:
            node = np.zeros(len(x), np.int64)
            while feature.size and node.max(initial=0) < len(feature):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - len(feature)]
        return out


@dataclass
class Binned:
    """Examples by the bins of their features: ``n`` equal ones, of which ``right`` are."""
    kind: np.ndarray
    place: np.ndarray  # of each feature: how many of its edges are less
    n: np.ndarray
    right: np.ndarray
    margin: np.ndarray

    def move(self, trees: dict[int, list[tuple]]) -> None:
        """Add the values of ``trees``, by kind: (feature, last bin to the left, value)."""
        for k, grown in trees.items():
            rows = np.flatnonzero(self.kind == k)
            for feature, cut, value in grown:
                self.margin[rows] += value[_node(self.place, rows, feature, cut, len(feature)) - len(feature)]

    def sums(self, now: dict[int, tuple], level: int, bins: int) -> dict[int, np.ndarray]:
        """By kind: gradients and Hessians in units, by node of a level, feature and bin."""
        width, size, out = 2**level, self.place.shape[1], {}
        for k, (feature, cut) in now.items():
            rows = np.flatnonzero(self.kind == k)
            if not len(rows):
                continue
            p = 1 / (1 + np.exp(-self.margin[rows]))
            n = self.n[rows]
            g = self.right[rows] * UNIT - n * np.rint(p * UNIT).astype(np.int64)
            h = n * np.rint(np.maximum(p * (1 - p), 1e-6) * UNIT).astype(np.int64)
            first = (_node(self.place, rows, feature, cut, width - 1) - (width - 1)) * bins
            own = np.empty((2, width, size, bins), np.int64)
            for f in range(size):
                key = first + self.place[rows, f]
                for i, v in enumerate((g, h)):
                    own[i, :, f] = _whole(key, v, width * bins).reshape(width, bins)
            out[k] = own
        return out


def _whole(key: np.ndarray, v: np.ndarray, size: int) -> np.ndarray:
    """Exact sums of whole numbers by key: halves of 26 bits add up without rounding."""
    return (np.bincount(key, v >> 26, size).astype(np.int64) << 26) + np.bincount(key, v & ((1 << 26) - 1), size).astype(np.int64)


def _node(place: np.ndarray, rows: np.ndarray, feature: np.ndarray, cut: np.ndarray, inner: int) -> np.ndarray:
    """The node below the first ``inner`` ones of a tree that each row falls to."""
    node = np.zeros(len(rows), np.int64)
    for _ in range((inner + 1).bit_length() - 1):
        node = 2 * node + 1 + (place[rows, feature[node]] > cut[node])
    return node


def _edges(values: np.ndarray, n: np.ndarray, bins: int = 32) -> np.ndarray:
    """The different quantiles of ``values`` that stand for ``n`` each: a bin's greatest."""
    order = np.argsort(values, kind="stable")
    upto = np.cumsum(n[order])
    at = (np.linspace(0, 1, bins)[1:-1] * (upto[-1] - 1)).astype(np.int64)
    return np.unique(values[order][np.searchsorted(upto, at, "right")])


def _places(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1).astype(np.uint8)  # value <= edges[place]


def grow(edges: dict[int, list[np.ndarray]], sums: Callable, added: Callable, rounds: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 32, ridge: float = 1.0, least: float = 1.0) -> dict[int, list[tuple]]:
    """Newton boosting of the logistic loss over binned features, one level of every
    kind's tree by a call of ``sums(now, level, bins)``; ``added`` gets each round's trees."""
    out: dict[int, list[tuple]] = {k: [] for k in edges}
    for _ in range(rounds if edges else 0):
        now = {k: (np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, 255, np.int64)) for k in edges}
        value = {k: np.zeros(2**depth) for k in edges}
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            for k, own in sums(now, level, bins).items():
                feature, cut = now[k]
                (gl, hl), (ga, ha) = own.cumsum(3) / UNIT, own[:, :, :1].sum(3, keepdims=True) / UNIT
                gain = gl**2 / (hl + ridge) + (ga - gl)**2 / (ha - hl + ridge) - ga**2 / (ha + ridge)
                gain = np.where((hl >= least) & (ha - hl >= least), gain, 0)
                for f, e in enumerate(edges[k]):
                    gain[:, f, len(e):] = 0
                at = gain.reshape(width, -1).argmax(1)  # the first feature and bin of the best
                better = np.flatnonzero(gain.reshape(width, -1)[np.arange(width), at] > 1e-3)
                feature[first + better], cut[first + better] = np.divmod(at[better], bins)
                if level == depth - 1:
                    nodes, last = np.arange(width), np.minimum(cut[first:], bins - 1)
                    left = np.stack([x[nodes, feature[first:], last] for x in (gl, hl)])
                    both = np.stack([left, np.stack([x[:, 0, 0] for x in (ga, ha)]) - left], 2).reshape(2, -1)
                    value[k] = rate * both[0] / (both[1] + ridge)
        trees = {k: [(*now[k], value[k])] for k in edges}
        for k, own in trees.items():
            out[k] += own
        added(trees)
    return out


def _as_trees(start: float, grown: list[tuple], edges: list[np.ndarray]) -> Trees:
    """Trees over values in place of bins."""
    return Trees(start, [(feature, np.array([edges[f][c] if c < 255 else np.inf for f, c in zip(feature.tolist(), cut.tolist(), strict=True)], float), value) for feature, cut, value in grown])


def _start(right: int, n: int) -> float:
    return float(np.log(right / (n - right))) if 0 < right < n else 20.0 if n and right else -20.0


def boost(x: np.ndarray, y: np.ndarray, **shape) -> Trees:
    """The trees of one kind whose examples are at hand (``shape``: as of ``grow``)."""
    start = _start(int(y.sum()), len(y))
    if not len(y) or y.min() == y.max():
        return Trees(start)
    edges = [_edges(x[:, f], np.ones(len(x), np.int64), shape.get("bins", 32)) for f in range(x.shape[1])]
    rows = Binned(np.zeros(len(y), np.int64), _places(x, edges), np.ones(len(y), np.int64), y.astype(np.int64), np.full(len(y), start))
    return _as_trees(start, grow({0: edges}, rows.sums, rows.move, **shape)[0], edges)


def calibrated(margin: np.ndarray, y: np.ndarray, n: np.ndarray | None = None, precision: float = PRECISION) -> float:
    """The least margin above which a share ``precision`` of held-out candidates (``n``
    with a margin, ``y`` of them right) is right (a half of one is counted as wrong, so
    that a few say little)."""
    order = np.argsort(-margin, kind="stable")
    right, n = np.cumsum(y[order]), np.cumsum(np.ones(len(y), np.int64) if n is None else n[order])
    last = np.append(margin[order][1:] != margin[order][:-1], True)
    ok = np.flatnonzero(last & (right - 0.5 >= precision * n) & (margin[order] > 0)) if len(y) else []
    return float(margin[order][ok[-1]]) if len(ok) else np.inf


@dataclass(frozen=True)
class Model:
    """For each kind its trees and the threshold of their margin."""
    trees: tuple[Trees, ...]
    thresholds: tuple[float, ...]

    def added(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Selected candidates that touch no other span, best first."""
        found = candidates(text)
        if not found:
            return []
        taken = sorted(base)
        starts, ends = np.array([b[0] for b in taken], np.int64), np.maximum.accumulate(np.array([b[1] for b in taken], np.int64)) if taken else np.zeros(0, np.int64)
        s, e = (np.array([c[i] for c in found]) for i in (0, 1))
        before = np.searchsorted(starts, e)  # base spans that start before a candidate's end
        free = np.flatnonzero((before == 0) | (np.append(ends, 0)[before - 1] <= s)).tolist()
        scored = []
        for lo in range(0, len(free), 20_000):
            part = [found[i] for i in free[lo:lo + 20_000]]
            x = np.array([features(text, *c) for c in part], np.float64)
            for kind in range(len(KINDS)):
                own = [i for i, c in enumerate(part) if c[2] == kind]
                if own and self.thresholds[kind] < np.inf:
                    margin = self.trees[kind].margin(x[own])
                    scored += [(-m, part[i]) for i, m in zip(own, margin.tolist(), strict=True) if m >= self.thresholds[kind]]
        out: list[tuple[int, int, int]] = []
        used = set()
        for _, (a, b, kind) in sorted(scored):
            if used.isdisjoint(range(a, b)):
                used.update(range(a, b))
                out.append((a, b, kind))
        return out


# ----------------------------------------------------------------- training


def _disguised(kind: int, span: str, r: Random) -> str:
    """Another way to write a verified span."""
    if kind == EMAIL:
        at, dot = r.choice([(" at ", " dot "), ("[at]", "[dot]"), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", "."), (" @ ", "."), ("{at}", "{dot}")])
        local, _, domain = span.rpartition("@")
        return local + at + domain.replace(".", dot)
    digits = _NOT_DIGIT.sub("", span)
    if kind == IP:
        return span.replace(".", r.choice(["[.]", "(.)", " . ", "[dot]", " dot "]))
    if kind == CARD:
        by = r.choice([4, 4, 4, 5])
        return r.choice([".", "/", "  ", " - ", ":"]).join(digits[i:i + by] for i in range(0, len(digits), by))
    own = digits[-10:]
    return r.choice(["00" + digits, f"({own[:3]}) {own[3:6]}-{own[6:]}", f"+{digits[:-10]}/{own[:3]}/{own[3:6]}/{own[6:]}", f"{own[:3]}-{own[3:6]}-{own[6:]}", f"{own[:3]}.{own[3:6]}.{own[6:]}"])


def _spoilt(kind: int, span: str, r: Random) -> str:
    """Something like a verified span that is none."""
    digits = [i for i, c in enumerate(span) if c in "0123456789"]
    if kind == EMAIL or not digits:
        return span.replace("@", r.choice([" ", ".", ""]))
    way = r.randrange(3)
    if way == 0:  # another number of the same length
        return "".join(str(r.randrange(10)) if c in "0123456789" else c for c in span)
    if way == 1:  # part of something longer
        return "".join(r.choice("abcdef0123456789") for _ in range(r.randint(1, 9))) + span.replace("+", "") + "".join(r.choice("abcdef") for _ in range(r.randint(1, 5)))
    return "".join(c + (str(r.randrange(10)) * (1 + r.randrange(4)) if i in digits[:1] + digits[-1:] else "") for i, c in enumerate(span))


def _noise(r: Random) -> str:
    """A number that may stand beside anything."""
    number = "".join(r.choice("0123456789") for _ in range(r.choice([1, 2, 4, 8, 16, 16])))
    return r.choice([number, ".".join(str(r.randrange(256)) for _ in range(4)), f"+{number[:2]} {number[2:]}5"])


def _touches(spans: list[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Whether a span overlaps one of ``spans``, which are in order of their starts."""
    starts, ends = [x for x, _ in spans], list(accumulate((y for _, y in spans), max))
    return lambda a, b: bool((i := bisect_left(starts, b)) and ends[i - 1] > a)


def examples(text: str) -> Iterator[tuple[int, int, list[float]]]:
    """(kind, right or wrong, features) of a text's candidates, and of those in
    altered copies of its verified spans: beside a number, beside one another, in a
    disguise, and spoilt.  What touches a match that was dropped is left out, as it may
    hold a right span or not."""
    found = matches(text)
    base = [(s, e, k) for s, e, k, ok in found if ok]
    unknown = _touches([(s, e) for s, e, _, ok in found if not ok and e - s > 6])
    r = Random(zlib.crc32(text.encode("utf-8", "replace")))
    truth = set(base)
    for s, e, k in candidates(text):
        if not unknown(s, e):
            yield k, int((s, e, k) in truth), features(text, s, e, k)
    for s, e, k in base:
        left, right, span = text[max(0, s - 40):s], text[e:e + 40], text[s:e]
        a, b, other = r.choice(base)
        pair = text[a:b]
        x, y = _noise(r), _noise(r)
        for inner, at in ((f"{span} {x}", 0), (f"{x} {span}", len(x) + 1), (f"{x} {span} {y}", len(x) + 1)):
            whole, first = left + inner + right, len(left) + at
            known = (first, first + len(span), k)
            near = [c for c in candidates(whole) if c[0] < known[1] and known[0] < c[1]]  # what the number is, nobody knows
            for c in near:
                yield c[2], int(c == known), features(whole, *c)
        for inner, true in (
            (f"{span} {pair}", [(0, len(span), k), (len(span) + 1, len(span) + 1 + len(pair), other)]),
            (f"{pair} {span}", [(0, len(pair), other), (len(pair) + 1, len(pair) + 1 + len(span), k)]),
            (changed := _disguised(k, span, r), [(0, len(changed), k)]),
            (_spoilt(k, span, r), []),
            (_spoilt(k, span, r), []),
        ):
            whole, at = left + inner + right, len(left)
            known = {(x + at, y + at, z) for x, y, z in true}
            if not true and any(ok and x < at + len(inner) and at < y for x, y, _, ok in matches(whole)):
                continue  # spoilt to another right one
            near = [c for c in candidates(whole) if at <= c[0] and c[1] <= at + len(inner) or c in known]
            for x, y, z in near:
                yield z, int((x, y, z) in known), features(whole, x, y, z)


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(kind, held, x array<int>, n, right)``: the examples of all distinct texts with a
    digit or an ``@`` (others have no verified match), equal ones counted; ``held`` are
    those of one text in ``HELD_OUT``."""
    body = F.col(text).cast("string")
    texts = docs.select(body.alias("text")).where(body.rlike("[0-9@]")).distinct()

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0).to_pylist():
                held, got = zlib.crc32(value.encode("utf-8", "replace")) % HELD_OUT == 1, examples(value)
                while part := list(islice(got, 10_000)):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([x[0] for x in part], pa.int32()), pa.array([held] * len(part), pa.bool_()),
                        pa.array([[int(v) for v in x[2]] for x in part], pa.list_(pa.int32())), pa.array([x[1] for x in part], pa.int32())], names=["kind", "held", "x", "right"])

    got = texts.transform(in_arrow, learn, "kind int, held boolean, x array<int>, right int")
    return got.groupBy("kind", "held", "x").agg(F.count("*").alias("n"), F.sum("right").alias("right"))


#: Examples by bins, with the margin that the trees so far give.
_BINNED = "kind int, held boolean, place binary, n long, right long, margin double"


def _binned(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, Binned]]:
    """Rows of ``_BINNED``, many at once."""
    held, size = [], 0
    for batch in batches:
        held, size = [*held, batch], size + len(batch)
        if size >= ROWS:
            yield _arrays(pa.Table.from_batches(held))
            held, size = [], 0
    if size:
        yield _arrays(pa.Table.from_batches(held))


def _arrays(t: pa.Table) -> tuple[pa.Table, Binned]:
    t = t.combine_chunks()
    place = np.frombuffer(b"".join(t.column("place").to_pylist()), np.uint8).reshape(len(t), FEATURES)
    kind, n, right, margin = (t.column(c).to_numpy() for c in ("kind", "n", "right", "margin"))
    return t, Binned(kind, place, n, right, margin.copy())


class InTasks:
    """``Binned`` rows of a stored table: sums and margins are made in tasks."""

    def __init__(self, rows: DataFrame):
        self.rows, self.trees, self.rounds = rows, {}, 0

    def sums(self, now: dict[int, tuple], level: int, bins: int) -> dict[int, np.ndarray]:
        shape, trees = (2**level, FEATURES, bins), self.trees

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for _, part in _binned(batches):
                part.move(trees)
                for k, own in part.sums(now, level, bins).items():
                    total[k] = total[k] + own if k in total else own
            for k, own in total.items():
                flat = own.reshape(2, -1)
                slot = np.flatnonzero(flat.any(0))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(slot), k), pa.int32()), pa.array(slot, pa.int32()), *[pa.array(v[slot], pa.int64()) for v in flat]], names=["kind", "slot", "g", "h"])

        got = self.rows.where("not held").transform(in_arrow, add, "kind int, slot int, g long, h long").groupBy("kind", "slot").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
        kind, slot, g, h = (got.column(c).to_numpy() for c in ("kind", "slot", "g", "h"))
        out = {}
        for k in sorted(set(kind.tolist())):
            out[k] = np.zeros((2, int(np.prod(shape))), np.int64)
            out[k][:, slot[kind == k]] = g[kind == k], h[kind == k]
            out[k] = out[k].reshape(2, *shape)
        return out

    def move(self, trees: dict[int, list[tuple]]) -> None:
        self.trees = {k: self.trees.get(k, []) + own for k, own in trees.items()}
        self.rounds += 1
        if self.rounds % STORED == 0:
            self.write()

    def write(self) -> None:
        """The margins of the trees so far, held-out rows too."""
        trees, old = self.trees, self.rows

        def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t, part in _binned(batches):
                part.move(trees)
                yield from t.set_column(t.schema.get_field_index("margin"), "margin", pa.array(part.margin)).to_batches(max_chunksize=10_000)

        self.rows, self.trees = store(old.transform(in_arrow, moved, _BINNED), "personal-margins"), {}
        discard(old)

    def cells(self) -> pa.Table:
        """``(kind, cell, n, right)`` of the held-out rows with a margin above 0."""
        if self.trees:
            self.write()
        cell = F.floor(F.col("margin") * CELLS).alias("cell")
        return self.rows.where("held and margin > 0").groupBy("kind", cell).agg(F.sum("n").alias("n"), F.sum("right").alias("right")).toArrow()


class InDriver:
    """The same of a table of few rows."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        table = rows.toArrow()
        held = table.column("held")
        self.fit, self.test = (_arrays(table.filter(on))[1] for on in (pc.invert(held), held))

    def sums(self, now: dict[int, tuple], level: int, bins: int) -> dict[int, np.ndarray]:
        return self.fit.sums(now, level, bins)

    def move(self, trees: dict[int, list[tuple]]) -> None:
        self.fit.move(trees)
        self.test.move(trees)

    def cells(self) -> pa.Table:
        t = self.test
        return pa.table({"kind": t.kind, "cell": np.floor(t.margin * CELLS).astype(np.int64), "n": t.n, "right": t.right})


def train(docs: DataFrame, text: str = "text") -> Model:
    """Learn from the verified matches in all distinct texts; one text in ``HELD_OUT``
    only calibrates, its margins taken down to whole ``CELLS``.  Without such texts
    nothing is added to the patterns."""
    got = store(counted(docs, text), "personal-examples")
    size = {(x["kind"], x["held"]): (x["n"], x["right"]) for x in got.groupBy("kind", "held").agg(F.sum("n").alias("n"), F.sum("right").alias("right")).collect()}
    start = [_start(*reversed(size.get((k, False), (0, 0)))) for k in range(len(KINDS))]
    learnt = [k for k in range(len(KINDS)) if 0 < size.get((k, False), (0, 0))[1] < size[k, False][0]]
    if not learnt:
        discard(got)
        return Model(tuple(map(Trees, start)), (np.inf,) * len(KINDS))
    values = got.where(~F.col("held") & F.col("kind").isin(learnt)).select("kind", "n", F.posexplode("x")).groupBy("kind", "pos", "col").agg(F.sum("n").alias("n")).toArrow()
    kind, pos, value, n = (values.column(c).to_numpy() for c in ("kind", "pos", "col", "n"))
    edges = {k: [_edges(value[own].astype(float), n[own]) for f in range(FEATURES) for own in [(kind == k) & (pos == f)]] for k in learnt}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, x = batch.column("kind").to_numpy(), batch.column("x").flatten().to_numpy().reshape(-1, FEATURES)
            out = np.zeros((len(kind), FEATURES), np.uint8)
            for k, own in edges.items():
                out[kind == k] = _places(x[kind == k], own)
            yield batch.set_column(batch.schema.get_field_index("x"), "place", pa.array([row.tobytes() for row in out], pa.binary()))

    rows = got.where(F.col("kind").isin(learnt)).transform(in_arrow, place, "kind int, held boolean, place binary, n long, right long")
    rows = rows.groupBy("kind", "held", "place").agg(F.sum("n").alias("n"), F.sum("right").alias("right"))
    rows = store(rows.withColumn("margin", F.get(F.array(*map(F.lit, start)), F.col("kind"))).select("kind", "held", "place", "n", "right", "margin"), "personal-binned")
    discard(got)
    model = InDriver(rows) if rows.count() <= LOCAL else InTasks(rows)
    grown = grow(edges, model.sums, model.move)
    cells = model.cells()
    kind, cell, n, right = (cells.column(c).to_numpy() for c in ("kind", "cell", "n", "right"))
    discard(model.rows)
    thresholds = [calibrated(cell[kind == k] / CELLS, right[kind == k], n[kind == k]) if k in learnt else np.inf for k in range(len(KINDS))]
    return Model(tuple(_as_trees(start[k], grown.get(k, []), edges.get(k, [])) for k in range(len(KINDS))), tuple(thresholds))


# ------------------------------------------------------------------ operator


def written(spans: list[tuple[int, int, int]]) -> str:
    """``kind:start:end`` by start, then kind, with commas between."""
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], x[2], x[1])))


def find(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one more column (its name is returned): struct of ``base`` (the
    spans of the plain patterns), ``added`` (those that the trees select besides),
    both array<struct<start, end, kind>> in order, in code points, end exclusive, and
    ``written``/``base_written`` (``kind:start:end``, with commas between).

    A pattern's matches are leftmost and do not overlap; what fails its check is
    dropped and not tried again.  Added spans overlap no other one.  Null and empty
    texts have none.  Row by row, no shuffle: repeated rows and keys do not matter.
    """
    column = fresh(docs.columns, "personal")
    spans = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.IntegerType())]))
    kind = T.StructType([T.StructField("base", spans), T.StructField("added", spans), T.StructField("base_written", T.StringType()), T.StructField("written", T.StringType())])
    marked = docs.withColumn(column, F.lit(None).cast(kind))
    at = len(docs.columns)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for rows, data, offs in chunks(batch, text):
                hints = np.concatenate(([0], np.cumsum(_HINTS[data])))
                on = np.diff(hints[offs]) > 0
                if b" dot " in data.tobytes().lower():
                    on |= np.array([b" dot " in data[a:b].tobytes().lower() for a, b in zip(offs[:-1], offs[1:], strict=True)])
                base, added = [[] for _ in range(len(rows))], [[] for _ in range(len(rows))]
                for i in np.flatnonzero(on).tolist():
                    value = data[offs[i]:offs[i + 1]].tobytes().decode("utf-8", "replace")
                    base[i] = [(s, e, k) for s, e, k, ok in matches(value) if ok]
                    added[i] = sorted(model.added(value, base[i]))
                as_rows = lambda x: pa.array([[{"start": s, "end": e, "kind": k} for s, e, k in own] for own in x], arrow)
                out = pa.StructArray.from_arrays([
                    as_rows(base), as_rows(added), pa.array([written(b) for b in base], pa.string()),
                    pa.array([written(b + a) for b, a in zip(base, added, strict=True)], pa.string())], ["base", "added", "base_written", "written"])
                yield rows.set_column(at, rows.schema.field(at), out)

    return marked.transform(in_arrow, run, marked.schema), column


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets, overlapping ones by
    one.  Texts without any stay as they are."""
    found, column = find(docs, model, text)

    def replace(spans: F.Column) -> F.Column:
        order = F.array_sort(F.concat(spans["base"], spans["added"]))
        names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
        body = F.col(text).cast("string")
        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
        step = lambda a, s: F.when(s["end"] <= a["at"], a).otherwise(F.struct(
            F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.substring(body, a["at"] + 1, s["start"] - a["at"]), F.get(names, s["kind"]))).alias("out"),
            s["end"].alias("at")))
        done = lambda a: F.concat(a["out"], F.substring(body, a["at"] + 1, F.char_length(body)))
        return F.aggregate(order, start, step, done)

    own = F.col(column)
    value = F.when(F.size(own["base"]) + F.size(own["added"]) > 0, replace(own)).otherwise(F.col(text))
    return found.withColumn(text, value).drop(column)
