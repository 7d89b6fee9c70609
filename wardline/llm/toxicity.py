"""Toxicity scores behind a noisy-channel deobfuscation.

Spans that look disguised (digits or signs among letters, stretched letters,
letters set apart) are decoded: every character of the span may stand for itself,
for the letter it resembles, or for nothing, and Viterbi's algorithm picks the
likeliest reading under a character model of the whole corpus.  Words and word
beginnings, as written and as restored, that go with the label add up to evidence,
and a logistic curve makes a probability of it.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import chunks, fresh, gram_hashes, in_arrow, runs, span_hashes, store
from wardline.llm.langid import _SYMBOL as SYMBOL

#: Labelled rows that the classifier is fitted on at most, the lengths of word
#: beginnings (bytes) that are features, and the least gain in log likelihood of one
#: (what pure chance would not give in a vocabulary).
SAMPLE, BEGINNINGS, GAIN = 50_000, (4, 5, 6, 7, 8), 12.0

# ------------------------------------------------------ character model

TRIGRAMS = 1 << 18


def _trigrams(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Codes (18 bits) of three symbols; all that is no letter, and a row's ends,
    is one blank symbol."""
    n = len(offs) - 1
    c = np.zeros(len(data) + 2 * n + 2, np.int32)
    c[np.arange(len(data)) + np.repeat(2 * np.arange(1, n + 1), np.diff(offs))] = SYMBOL[data]
    return (c[:-2] << 12 | c[1:-1] << 6 | c[2:])[(c[1:-1] != 0) | (c[2:] != 0)]


def character_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Costs (-log probability, float32) of a symbol after two others, from all
    texts of ``docs``.  Each task counts its rows into one table of ``TRIGRAMS``
    cells; the tables are summed by cell, at most ``TRIGRAMS`` rows come back."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(TRIGRAMS, np.int64)
        for batch in batches:
            for _, data, offs in chunks(batch, "text"):
                total += np.bincount(_trigrams(data, offs), minlength=TRIGRAMS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["code", "n"])

    rows = (docs.select(F.col(text).cast("string").alias("text")).transform(in_arrow, count, "code int, n long")
            .groupBy("code").agg(F.sum("n").alias("n")).toPandas())
    n = np.zeros(TRIGRAMS)
    n[rows["code"].to_numpy()] = rows["n"].to_numpy()
    three = n.reshape(64, 64, 64)
    two, one = three.sum(0), three.sum((0, 1))
    p1 = (one + 0.5) / (one.sum() + 32)
    p2 = (two + 8 * p1) / (two.sum(1, keepdims=True) + 8)
    p3 = (three + 4 * p2) / (three.sum(2, keepdims=True) + 4)
    return -np.log(p3).astype(np.float32).reshape(-1)


# ------------------------------------------------------------- decoding

# The letters that signs stand for.
LOOKS_LIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "(": "c", "<": "c", "*": "aeiou", "#": "h"}
AS_SIGN, DROP_SIGN, DROP_REPEAT, DROP_GAP, KEEP_GAP, BREAK = 0.7, 7.0, 0.3, 0.1, 3.0, 7.0

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_SIGN = np.zeros(256, bool)
_SIGN[[ord(x) for x in LOOKS_LIKE]] = True
_GAP = np.zeros(256, bool)
_GAP[list(b" .-_/,~:")] = True
#: Characters between letters that are set apart, at most.
WIDEST_GAP = 3
#: Punctuation around a token that stands for no letter, and signs that may be
#: punctuation at its ends.
_AROUND, _ENDS = b".,;:?\"')>-_", b"!(<*#+|"
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\f\v")] = True


def _options() -> list[list[tuple[int, int, float]]]:
    """For each byte its readings: byte (-1: none), its symbol, cost; blanks within a
    word and repeats are up to the place."""
    out = []
    for b in range(256):
        ch = chr(b)
        if _GAP[b]:
            out.append([(-1, 0, DROP_GAP), (32, 0, KEEP_GAP)])
        elif ch in LOOKS_LIKE:
            out.append([(ord(x), int(SYMBOL[ord(x)]), AS_SIGN) for x in LOOKS_LIKE[ch]] + [(-1, 0, DROP_SIGN)])
        else:
            out.append([(b, int(SYMBOL[b]), 0.0)])
    return out


_READINGS = _options()
_SIGNS = {ord(x) for x in LOOKS_LIKE}


def decode(span: bytes, cost: list[float]) -> bytes:
    """The likeliest reading of a disguised span: lower-case words, one blank
    between.  Signs at the ends may be punctuation."""
    first, after = len(span) - len(span.lstrip(_ENDS)), len(span.rstrip(_ENDS))
    paths = {0: (0.0, None)}  # last two symbols (6 bits each) -> cost, (byte, before)
    last = -1
    for i, b in enumerate(span.lower()):
        options = _READINGS[b]
        if b in _SIGNS:
            options = [*options, (32, 0, BREAK if first <= i < after else 0.0)]
        elif b == last and not _GAP[b]:
            options = [*options, (-1, 0, DROP_REPEAT)]
        last = b
        then: dict = {}
        for state, (c, back) in paths.items():
            for out, z, extra in options:
                if out < 0 or not (z or state & 63):
                    to, total, path = state, c + extra, back
                else:
                    to, total, path = (state & 63) << 6 | z, c + extra + cost[state << 6 | z], (out, back)
                had = then.get(to)
                if had is None or total < had[0]:
                    then[to] = (total, path)
        paths = then
    ends = ((c + cost[state << 6] if state & 63 else c, path) for state, (c, path) in paths.items())
    _, path = min(ends, key=lambda e: e[0])
    out = bytearray()
    while path:
        out.append(path[0])
        path = path[1]
    return bytes(reversed(out))


def _fold(data: np.ndarray) -> np.ndarray:
    """Lower case (a-z and Latin-1 letters), 0 for what is no letter."""
    d = data.copy()
    d[(d >= 65) & (d <= 90)] += 32
    up = np.flatnonzero((d[:-1] == 0xC3) & (d[1:] >= 0x80) & (d[1:] <= 0x9E) & (d[1:] != 0x97)) + 1
    d[up] += 32
    d[(d < 97) | ((d > 122) & (d < 128))] = 0
    return d


class Reader:
    """Words of texts, as written and as restored."""

    def __init__(self, cost: np.ndarray):
        self.cost = cost
        self.costs: list[float] = cost.tolist()
        self.known: dict[bytes, bytes] = {}

    def restored(self, span: bytes) -> bytes:
        found = self.known.get(span)
        if found is None:
            if len(self.known) > 100_000:
                self.known.clear()
            found = self.known[span] = decode(span, self.costs)
        return found

    def _apart(self, data: np.ndarray, offs: np.ndarray) -> Iterator[tuple[int, int]]:
        """Bytes from, to of three single characters or more, set apart."""
        gap = _GAP[data]
        s, e, w = runs(~gap, offs)
        if len(s) < 3:
            return
        first = data[s]
        single = (e - s == 1) & (first < 128) & (_LETTER[first] | _SIGN[first])
        single |= (e - s == 2) & (first == 0xC3)
        row = np.repeat(np.arange(len(offs) - 1), np.diff(w))
        joins = single[1:] & single[:-1] & (row[1:] == row[:-1]) & (s[1:] - e[:-1] <= WIDEST_GAP)
        edge = np.diff(np.concatenate(([0], joins.view(np.int8), [0])))
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            if b - a >= 2:
                yield int(s[a]), int(e[b])

    def _stretched(self, norm: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words with several doubled letters; words with one that the decoder reads as
        a single letter, and the places of the letters to leave out.

        With one such pair only the costs of the second letter and of the one after it
        differ between the two readings, so the decoder's choice is known."""
        pair = np.flatnonzero((norm[1:] == norm[:-1]) & (norm[1:] != 0))
        word = np.searchsorted(s, pair, "right") - 1
        many = np.bincount(word, minlength=len(s))
        pair, one = pair[many[word] == 1], word[many[word] == 1]
        sym = SYMBOL[np.concatenate(([0], norm, [0, 0]))].astype(np.int64)  # words have a blank before and after
        before, letter, after = sym[pair], sym[pair + 1], sym[pair + 3]
        keep = self.cost[before << 12 | letter << 6 | letter] + self.cost[letter << 12 | letter << 6 | after]
        drop = self.cost[before << 12 | letter << 6 | after] + np.float32(DROP_REPEAT)
        return np.flatnonzero(many > 1), one[drop < keep], pair[drop < keep]

    def spans(self, data: np.ndarray, offs: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(row, disguised span)."""
        whole, ends = data.tobytes(), offs.tolist()
        for a, b in self._apart(data, offs):
            yield bisect.bisect_right(ends, a) - 1, whole[a:b]
        # tokens with a sign and a letter, or a gap between letters
        ext = np.concatenate((data, np.full(2, 32, np.uint8)))
        letter, sign, gap = _LETTER[ext], _SIGN[ext], _GAP[ext]
        space = np.flatnonzero(_SPACE[data])
        token = lambda on: np.unique(np.searchsorted(space, np.flatnonzero(on)))
        between = gap[1:-1] & (ext[1:-1] != 32) & letter[2:] & letter[:-2]
        place = np.union1d(np.intersect1d(token(sign[:-2]), token(letter[:-2]), assume_unique=True), np.unique(np.searchsorted(space, np.flatnonzero(between) + 1)))
        starts, stops = np.concatenate(([0], space + 1))[place], np.append(space, len(data))[place]
        rows = np.searchsorted(offs, starts, "right") - 1
        for a, b, d in zip(starts.tolist(), stops.tolist(), rows.tolist(), strict=True):
            while a < b:  # a token that crosses rows is one for each
                end = min(b, ends[d + 1])
                if end - a > 2:
                    yield d, whole[a:end].strip(_AROUND)
                a, d = end, d + 1

    def features(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and hashes of the words and word beginnings in them; repeated."""
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        norm = _fold(data)
        s, e, w = runs(norm != 0, offs)
        rows = [np.repeat(np.arange(len(offs) - 1), np.diff(w))]
        parts = [(norm, s, e)]
        several, one, out = self._stretched(norm, s, e)
        if len(one):
            size = e[one] - s[one]
            ends = np.cumsum(size)
            at = np.repeat(s[one] - (ends - size), size) + np.arange(ends[-1])
            rows.append(rows[0][one])
            parts.append((norm[np.delete(at, out - s[one] + ends - size)], ends - size - np.arange(len(one)), ends - np.arange(len(one)) - 1))
        found = [(d, self.restored(x)) for d, x in self.spans(data, offs)]
        found += [(d, self.restored(norm[a:b].tobytes())) for a, b, d in zip(s[several].tolist(), e[several].tolist(), rows[0][several].tolist(), strict=True)]
        if found:
            more = np.frombuffer(b" ".join(x for _, x in found), np.uint8)
            ends = np.cumsum([0] + [len(x) + 1 for _, x in found])
            ends[-1] -= 1
            folded = _fold(more)
            s2, e2, w2 = runs(folded != 0, ends)
            of = np.array([d for d, _ in found])
            rows.append(of[np.searchsorted(w2, np.arange(len(s2)), "right") - 1])
            parts.append((folded, s2, e2))
        out_rows, hashes = [], []
        for r, (text, a, b) in zip(rows, parts, strict=True):
            out_rows.append(r)
            hashes.append(span_hashes(text, a, b))
            for n in BEGINNINGS:
                long = np.flatnonzero(b - a >= n)
                out_rows.append(r[long])
                hashes.append(span_hashes(text, a[long], a[long] + n) + np.uint64(n))
        return np.concatenate(out_rows), np.concatenate(hashes)


# --------------------------------------------------------------- scores

@dataclass(frozen=True)
class Model:
    cost: np.ndarray
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    slope: float
    bias: float

    def evidence(self, rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
        """For each of n rows the sum of the weights of the features in it."""
        f = self.features
        if not len(f) or not len(hashes):
            return np.zeros(n)
        bits = np.zeros(1 << 16, bool)
        bits[f & np.uint64(0xFFFF)] = True
        may = np.flatnonzero(bits[hashes & np.uint64(0xFFFF)])
        r, h = rows[may], hashes[may]
        at = np.minimum(np.searchsorted(f, h), len(f) - 1)
        pair = np.unique(r[f[at] == h] * len(f) + at[f[at] == h])
        return np.bincount(pair // len(f), self.weights[pair % len(f)], n).astype(float)  # integers if there is no pair


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of the logistic curve (Newton's method)."""
    design = np.stack([x, np.ones(len(x))], 1)
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hess = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hess, design.T @ (p - y) + ridge * w)
        w -= np.clip(step, -2, 2)
    return float(max(w[0], 0.0)), float(w[1])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """``docs(doc_id, text)``: all texts, for the character model.
    ``labels(doc_id, toxic)``: what may be learnt from; several labels of a
    document count as toxic if one is, null ones are skipped.  The classifier is
    fitted on ``sample`` labelled rows at most (those first in a hash order of
    doc_id), of which near copies, found by their least shingle, count once.
    Features are what makes the label likelier by more than chance; one's evidence
    is -log(1 - p) of the share p of its rows that are toxic beyond the base rate.
    """
    spark = docs.sparkSession
    cost = character_model(docs)
    shared = spark.sparkContext.broadcast(cost)
    chosen = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = store(docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
                 .where("toxic in (0, 1)"), "toxicity-sample")

    def own(batch: pa.RecordBatch, reader: Reader) -> Iterator[tuple]:
        for part, data, offs in chunks(batch, "text"):
            r, h = reader.features(data, offs)
            order = np.lexsort((h, r))
            r, h = r[order], h[order]
            new = np.concatenate(([True], (r[1:] != r[:-1]) | (h[1:] != h[:-1]))) if len(r) else np.zeros(0, bool)
            yield part.column(0).to_numpy(zero_copy_only=False), r[new], h[new]

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in chunks(batch, "text"):
                norm = _fold(data) if len(data) else data
                s, e, w = runs(norm != 0, offs)
                wh = span_hashes(norm, s, e)
                keys = [int(gram_hashes(wh[a:b], min(5, b - a)).min().view(np.int64)) if b > a else -i for i, (a, b) in enumerate(zip(w[:-1].tolist(), w[1:].tolist(), strict=True))]
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("doc_id")), pa.array(keys, pa.int64())], names=["doc_id", "least"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    alone = rows.select("doc_id", "text").transform(in_arrow, least, f"doc_id {kind}, least long").groupBy("least").agg(F.min("doc_id").alias("doc_id"))
    rows = store(rows.join(F.broadcast(alone.select("doc_id")), "doc_id").select("toxic", "text"), "toxicity-alone")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in batches:
            for y, r, h in own(batch, reader):
                hs, at = np.unique(h, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(hs.view(np.int64)), pa.array(np.bincount(at, y[r]).astype(np.int64)), pa.array(np.bincount(at))], names=["h", "toxic", "n"])

    totals = rows.agg(F.sum("toxic").alias("p"), F.count("*").alias("n")).first()
    p, n = totals["p"] or 0, totals["n"]
    if not p or p == n:
        return Model(cost, np.zeros(0, np.uint64), np.zeros(0), 0.0, 30.0 if p else -30.0)
    a, k, rate = F.col("toxic").cast("double"), F.col("n").cast("double"), p / n
    gain = a * F.log(a / (k * rate)) + F.when(k > a, (k - a) * F.log((k - a) / (k * (1 - rate)))).otherwise(0.0)
    best = (rows.transform(in_arrow, count, "h long, toxic long, n long").groupBy("h").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
            .where(a > k * rate).where(gain >= GAIN).select("h", "toxic", "n").toPandas())  # of the bounded sample's words
    order = np.argsort(best["h"].to_numpy(np.int64).view(np.uint64))
    features = best["h"].to_numpy(np.int64).view(np.uint64)[order]
    share = (best["toxic"].to_numpy(float)[order] + rate) / (best["n"].to_numpy(float)[order] + 1)
    weights = -np.log1p(-np.clip((share - rate) / (1 - rate), 0, 0.99))
    model = Model(cost, features, weights, 1.0, 0.0)
    known = spark.sparkContext.broadcast(model)

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = known.value
        reader = Reader(m.cost)
        for batch in batches:
            for part, data, offs in chunks(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int32()), pa.array(m.evidence(*reader.features(data, offs), len(part)))], names=["toxic", "x"])

    got = rows.transform(in_arrow, evidence, "toxic int, x double").toPandas()
    slope, bias = _fit(got["x"].to_numpy(), got["toxic"].to_numpy(float))
    return Model(cost, features, weights, slope, bias)


def score(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one more column (its name is returned): the probability
    that the text is toxic.  Null and empty texts get that of a text without any
    telling word.  Row by row, no shuffle; the model has a fixed size."""
    column = fresh(docs.columns, "toxicity")
    marked = docs.withColumn(column, F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        reader = Reader(m.cost)
        for batch in batches:
            for rows, data, offs in chunks(batch, text):
                x = m.slope * m.evidence(*reader.features(data, offs), len(rows)) + m.bias
                p = 1 / (1 + np.exp(-np.clip(x, -30, 30)))
                yield rows.set_column(rows.num_columns - 1, rows.schema.field(rows.num_columns - 1), pa.array(p))

    return marked.transform(in_arrow, run, marked.schema), column
