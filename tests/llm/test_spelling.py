"""Spelling variants against a plain version: nulls, ties, repeated rows, long words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from wardline.llm import spelling

WORD = re.compile("[A-Za-z\u00c0-\u00ff]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(docs):
    n = Counter()
    for key, text in docs:
        for w in WORD.findall(text or ""):
            w = lower(w)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                n[w] += 1
    n = {w: c for w, c in n.items() if c >= 2}
    letters = sorted(set("".join(n)))
    near = {}
    for w in n:
        if len(w) > 60:
            near[w] = {v for v in n if abs(len(v) - len(w)) <= 1 and one_edit(v, w)}
            continue
        edits = {w[:i] + w[i + 1:] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
        edits |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        near[w] = (edits & set(n)) - {w}
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda v: (-n[v], v))
            if n[best] >= 10 * n[w]:
                form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def one_edit(a, b):
    if a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(12)
    syllables = ["ab", "b\u00e9", "ca", "d\u00ffe", "\u00c0o", "zz", "a", "\u00d7n", "Ti"]
    base = ["".join(r.choice(syllables) for _ in range(r.randint(3, 6))) for _ in range(40)]
    frequent = [w for w in base[:8] for _ in range(40)]
    typo = lambda w: w[:(i := r.randrange(len(w)))] + r.choice(["", "q", w[i] + "\u00e8", "z"]) + w[i + 1:]
    words = base * 3 + frequent + [typo(w) for w in base * 8]
    words += [w for v in [typo(w) for w in base[:8]] for w in [v] * 3 + [typo(v)] * 2]
    words += ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa"] * 3 + ["x" * 300, "x" * 301, "x" * 299 + "y", "x" * 300] * 2 + ["w\u4e2dordword", "\u0100abcdefg"] * 3
    r.shuffle(words)
    docs, at = [], 0
    while at < len(words):
        k = r.randint(1, 30)
        docs.append((len(docs) * 7 - 3, r.choice([" ", "1", "\u00a0", "\n", "-"]).join(words[at:at + k])))
        at += k
    return docs + [(900, None), (901, ""), (None, "tidyword Tidyword tidywort"), (902, "\u00c3" * 9 + " " + "\u00ff" * 9), *docs[:3], docs[5], (903, docs[6][1]),
                   *[(k, " ".join("nearby" + c + "word" for c in "abcdefghij")) for k in (904, 905, 906, 907)]]


@pytest.mark.parametrize("limit", [spelling.BYTES, 200])
def test_equals_plain(spark, rows, monkeypatch, limit):
    monkeypatch.setattr(spelling, "HELD", 500)
    near = spelling.near_pairs
    monkeypatch.setattr(spelling, "near_pairs", lambda w: near(w, limit))
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'a' as word", "1 as n").repartition(3)
    got = spelling.variants(docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(x) for x in got.collect()]
    want = plain(rows)
    assert len(got) == len(set(got)) and set(got) == want
    assert any(x[1] for x in want) and max(x[4] for x in want) > 5


def test_empty_tables(spark):
    for rows in ([], [(1, None), (2, ""), (3, "short words only")]):
        assert spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0


def test_chain_of_forms(spark):
    words = ["aaaaaaaa", "aaaaaaab", "aaaaaabb", "aaaaabbb"]
    text = "\n".join(" ".join([w] * (2 * 11**i)) for i, w in enumerate(words))
    key = next(k for k in range(1000) if not any(zlib.crc32(f"{k}:{w}".encode()) % 31 == 0 for w in words))
    got = {r["word"]: r for r in spelling.variants(spark.createDataFrame([(key, text)], "doc_id long, text string")).collect()}
    assert {r["root"] for r in got.values()} == {"aaaaabbb"} and got["aaaaaaaa"]["form"] == "aaaaaaab"


def test_code_points_there_and_back():
    words = ["abc", "\u00e9", "", "\u00ff\u00c0z", "x" * 9, "\u00c3\u0083".replace("\u0083", "\u00c3")]
    column = pa.array(["skip", *words]).slice(1)
    back = {}
    for at, points in spelling.by_length(column):
        for i, w in zip(at.tolist(), spelling.to_strings(points, points.shape[1]).to_pylist(), strict=True):
            back[i] = w
            assert points.dtype == np.uint8
    assert [back[i] for i in range(len(words))] == words


def test_crc():
    r = random.Random(5)
    data = bytes(r.randrange(256) for _ in range(1000))
    s = np.array([r.randrange(900) for _ in range(200)])
    e = s + np.array([r.choice([0, 1, 5, 30, 64, 65, 99]) for _ in range(200)])
    before = np.array([r.getrandbits(32) for _ in range(200)], np.uint32)
    got = spelling.crc32_of(before, np.frombuffer(data, np.uint8), s, e)
    assert got.tolist() == [zlib.crc32(data[a:b], int(c)) for a, b, c in zip(s, e, before, strict=True)]
