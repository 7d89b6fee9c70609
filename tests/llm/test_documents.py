"""Decontamination, line and document deduplication, repeats and packing on
fixtures with nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from wardline.llm import decontaminate, lines, neardup, packing, repeats

rnd = random.Random(7)
VOCABULARY = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 7))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return "".join(r.choice(VOCABULARY) + r.choice([" "] * 9 + [".\n", ", "]) for _ in range(n)).strip()


def edited(text, seed, share=0.01):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) if r.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="module")
def rows():
    out = [(i, prose(rnd.randint(1, 200), i)) for i in range(40)]
    out += [(100 + i, edited(out[i % 5][1], i)) for i in range(30)]
    out += [(200, None), (201, ""), (202, "  \n\n "), (203, prose(6000, 3)), (204, prose(6000, 3)), (205, "ab ab " * 300), (206, out[7][1]), (207, "Ab  AB"), (208, "a\0b\U0001F600 é")]
    out += [(300 + i, "The very same opening line of a template\n" + prose(30, 500 + i)) for i in range(10)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    # repeated rows, and columns whose names the operators use themselves
    return spark.createDataFrame([(i, t, "x", 1, [2]) for i, t in rows + rows[:3]], "doc_id long, text string, hits string, id int, spans array<int>").repartition(3)


@pytest.fixture(scope="module")
def benchmark(spark, rows):
    items = [(1, " ".join(rows[3][1].split()[:25])), (2, "ab AB"), (3, None), (4, ""), (5, rows[8][1]), (5, rows[9][1]), (None, rows[10][1]), (10, rows[8][1])]
    return items, spark.createDataFrame(items, "item_id long, text string")


def test_decontamination(docs, rows, benchmark):
    items, table = benchmark
    want = brute.contaminated(rows, items)
    out, c = decontaminate.annotate(docs, table)
    got = out.collect()
    assert len(got) == docs.count() and c != "hits"
    for r in got:
        n, hit, ids = want[r["doc_id"]]
        assert (r[c]["n_words"], r[c]["n_hit"], r[c]["items"]) == (n, hit, [i for i in ids if i is not None])
    clean = decontaminate.remove_documents(docs, table)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {i for i, (_, hit, _) in want.items() if not hit}
    cut = decontaminate.remove_spans(docs, table).collect()
    for r in cut:
        n, hit, _ = want[r["doc_id"]]
        assert len(brute.words(r["text"])) == n - hit


def test_decontamination_in_several_passes(docs, rows, benchmark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_WINDOWS", 60)
    want = brute.contaminated(rows, benchmark[0])
    out, c = decontaminate.annotate(docs, benchmark[1])
    for r in out.collect():
        assert (r[c]["n_hit"], r[c]["items"]) == (want[r["doc_id"]][1], [i for i in want[r["doc_id"]][2] if i is not None])


def test_decontamination_with_ids_that_are_texts(spark, docs, rows, benchmark):
    items = [(None if i is None else f"item-{i}", t) for i, t in benchmark[0]]
    want = brute.contaminated(rows, items)
    out, c = decontaminate.annotate(docs, spark.createDataFrame(items, "item_id string, text string"))
    for r in out.collect():
        assert (r[c]["n_hit"], r[c]["items"]) == (want[r["doc_id"]][1], sorted(i for i in want[r["doc_id"]][2] if i is not None))


def test_empty_tables(spark, docs, benchmark):
    none = docs.limit(0)
    out, c = decontaminate.annotate(none, benchmark[1])
    assert out.count() == 0
    out, c = decontaminate.annotate(docs, benchmark[1].limit(0))
    assert out.where(F.col(c)["n_hit"] > 0).count() == 0
    assert neardup.near_duplicates(none).count() == 0
    assert lines.dedup_lines(none).columns == docs.columns and lines.near_lines(none).count() == 0
    assert repeats.cut_repeats(none)[0].count() == 0
    assert packing.pack(none).count() == 0


def test_near_duplicates(docs, rows):
    want = brute.near_documents(rows, 85)
    got = {r["doc_id"]: r for r in neardup.near_duplicates(docs).collect()}
    assert set(got) == set(want)
    for i, t in rows:
        assert got[i]["n_shingles"] == len(brute.shingles(t))
        assert got[i]["component_id"] == want[i] and got[i]["kept"] == (want[i] == i)
    left = neardup.drop_near_duplicates(docs, threshold=85)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {i for i, w in want.items() if i == w}


def test_chain_of_near_duplicates_is_one_component(spark):
    words = [f"w{i}" for i in range(130)]
    rows = [(i, " ".join(words[3 * i:3 * i + 60])) for i in range(20)]  # neighbours share 53 of 59 shingles
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["component_id"] for r in got.collect()} == {0}
    assert set(brute.near_documents(rows, 85).values()) == {0}


def test_lines(docs, rows):
    keep, every = brute.kept_lines(rows)
    got = {(r["key"], r["no"]): r["kept"] for r in lines.near_lines(docs).collect()}
    kept = {p for p, k in got.items() if k}
    # no line goes without a link; banding may miss a link of short lines
    assert set(got) == every and keep <= kept and len(kept - keep) <= 0.01 * len(every)
    out = lines.dedup_lines(docs)
    assert out.columns == docs.columns
    want = {}
    for i, t in rows:
        if t is not None:
            left = [x for no, x in enumerate(t.split("\n")) if (i, no) in kept or (i, no) not in every]
            if "".join(left).strip(" \t\r\f\x0b") or len(left) == len(t.split("\n")):
                want[i] = "\n".join(left)
    assert {r["doc_id"]: r["text"] for r in out.collect() if r["text"] is not None} == want


def test_fuzzy_lines_have_high_recall(spark):
    base = [prose(60, 900 + i).replace("\n", " ") for i in range(60)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, edited(t, i, 0.02)) for i, t in enumerate(base)]
    keep, _ = brute.kept_lines(rows)
    got = {(r["key"], r["no"]) for r in lines.near_lines(spark.createDataFrame(rows, "doc_id long, text string")).where("kept").collect()}
    assert len(got ^ keep) <= 2


@pytest.mark.parametrize("together", [256, 0])
def test_repeats(docs, rows, monkeypatch, together):
    monkeypatch.setattr(repeats, "TOGETHER", together)
    monkeypatch.setattr(repeats, "COLLECTION", 3000)
    monkeypatch.setattr(repeats, "PIECE", 9000)
    want = brute.without_repeats(rows)
    out, c = repeats.cut_repeats(docs)
    for r in out.collect():
        n, removed, spans, kept = want[r["doc_id"]]
        assert (r[c["removed"]], len(r[c["spans"]]), bytes(r[c["kept"]])) == (removed, spans, kept)


def test_rows_of_one_key_lose_only_their_own_bytes(spark):
    passage, unique = prose(60, 77)[:150], [prose(80, 800 + i) for i in range(6)]
    rows = [(None, passage + unique[0]), (None, unique[1] + passage), (3, unique[2]), (3, unique[3] + passage + unique[4][:50]), (3, unique[3] + passage + unique[4][:50]), (9, unique[5] + passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as copy", "2 as doc").repartition(3)
    out, c = repeats.cut_repeats(docs)
    got = out.collect()
    assert out.columns[:4] == docs.columns and len(got) == len(rows)
    # in the order of key, then hash of the text, one copy of the passage stays
    def digest(t):
        return spark.sql("SELECT xxhash64(0, :t)", {"t": t}).first()[0]
    distinct = sorted({(k, t) for k, t in rows}, key=lambda x: (x[0] is not None, x[0] or 0, digest(x[1])))
    want = brute.without_repeats([(i, t) for i, (_, t) in enumerate(distinct)])
    for r in got:
        n, removed, spans, kept = want[distinct.index((r["doc_id"], r["text"]))]
        assert (r[c["removed"]], len(r[c["spans"]]), bytes(r[c["kept"]])) == (removed, spans, kept)
    assert sum(r[c["removed"]] > 0 for r in got) in (3, 4)


def test_equal_windows():
    r = random.Random(1)
    for _ in range(50):
        w = r.choice([3, 5])
        segs = [bytes(r.choice(b"ab\0c\xff") for _ in range(r.randint(w, w + 12))) for _ in range(r.randint(2, 12))]
        want = {}
        for i, s in enumerate(segs):
            for j in range(len(s) - w + 1):
                want.setdefault(s[j:j + w], []).append((i, j))
        got = sorted(sorted(zip(a.tolist(), b.tolist(), strict=True)) for a, b in repeats.equal_windows(segs, w))
        assert got == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_packing(docs, rows):
    from tokenizers import Tokenizer
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    once = docs.dropDuplicates(["doc_id"]).repartition(3)
    got = packing.pack(once).toPandas()
    for i, t in rows:
        own = got[got.doc_id == i].sort_values("start")
        ids = np.concatenate([np.frombuffer(x, "<u4") for x in own.ids])
        assert ids.tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        assert own.start.tolist() == [0, *own.length.cumsum().tolist()[:-1]] and set(own.doc_tokens) == {len(ids)}
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]]
        assert s.length.sum() == s.tier.iloc[0] <= 1024 and s.tier.iloc[0] & (s.tier.iloc[0] - 1) == 0
    assert packing.pack(docs).agg(F.sum("length")).first()[0] > got.length.sum()  # repeated rows are packed again


@pytest.mark.parametrize("text", ["<|endoftext|>", "a <|endoftext|>b", "  \n\t x  ", "'S it's  　x", "\U0001F600‍�", "1234567 ½²٣", "", "a" * 3000, "\0\x01", "ǅ́İı"])
def test_ids_equal_tokenizers(text):
    from tokenizers import Tokenizer
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packing.token_ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
