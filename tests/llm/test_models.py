"""Language ID and toxicity: held-out accuracy and odd inputs."""

import numpy as np
from pyspark.sql import functions as F

from wardline.llm import langid, queries, toxicity

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = queries.op5_language(spark, SF).join(docs, "doc_id").where("held_out")
    n, right = got.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 200 and right / n >= 0.99


def test_language_rows(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "x", None), (5, "", "de")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, lang string, language string")
    model = langid.train(docs)
    assert model.languages == ["de", "en"]
    more = spark.createDataFrame([(6, "12 !? …", "", ""), (7, "DIE KATZE und", "", ""), (8, "語", "", ""), (8, "語", "", "")], docs.schema)
    out, c = langid.identify(docs.unionAll(more), model)
    got = {r["doc_id"]: r[c]["lang"] for r in out.collect()}
    assert c == "language_" and out.columns == [*docs.columns, c] and out.count() == 9
    assert (got[1], got[2], got[3], got[5], got[6], got[7]) == ("en", "de", "und", "und", "und", "de") and got[8] in ("de", "en")
    assert langid.identify(docs.limit(0), model)[0].count() == 0
    none = langid.train(docs.limit(0))
    assert {r[c]["lang"] for r in langid.identify(docs, none)[0].collect()} == {"und"}


def test_slots_agree():
    code = np.array([0, 1, 63 << 18 | 5, 2**24 - 1], np.uint32)
    for s, m in zip(langid.slots(code), langid._MULTIPLY, strict=False):
        assert s.tolist() == [(int(c) * m % 2**32) >> 12 for c in code]


def test_toxicity_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = queries.op3_toxicity(spark, "/root/testdata/sf0.1").where("held_out").join(labels, "doc_id").toPandas()
    # junk documents (quality 0) have labels at random; of one language there are 24 toxic texts only
    bad, fine = got[(got.toxic == 1) & (got.quality == 1)], got[got.toxic == 0]
    assert len(bad) > 80 and bad.predicted.mean() >= 0.9 and fine.predicted.mean() <= 0.01
    assert got.score.between(0, 1).all()
    # all held-out labels, those that no text explains with them
    every = got[got.toxic == 1]
    order = got.score.rank().to_numpy()
    auc = (order[(got.toxic == 1).to_numpy()].sum() - len(every) * (len(every) + 1) / 2) / (len(every) * len(fine))
    assert len(every) > 110 and every.predicted.mean() >= 0.82 and auc >= 0.95


def corpus(spark):
    words = "the cat sat on a mat and saw the stupid dog by the old wall of a house with moron trash loser here".split()
    r = np.random.default_rng(1)
    plain = [w for w in words if w not in ("stupid", "moron", "trash", "loser")]
    rows = []
    for i in range(400):
        text = " ".join(r.choice(plain, 30)) + (" " + " ".join(r.choice(["stupid", "moron", "trash", "loser"], 2)) if i % 4 == 0 else "")
        rows.append((i, " ".join(r.permutation(text.split())) + f" x{i}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))


def test_disguised_words_are_restored(spark):
    docs, labels = corpus(spark)
    model = toxicity.train(docs, labels)
    for span, want in {"m0r0n": "moron", "s t u p i d": "stupid", "stuuupiiid": "stupid", "tr@sh": "trash", "l.0.s.3.r": "loser", "m-o-r-o-n": "moron",
                       "s  t  u  p  i  d": "stupid", "s/t/u/p/i/d": "stupid", "l, o, s, e, r": "loser"}.items():
        assert toxicity.decode(span.encode(), model.cost).decode() == want
    apart = ["s  t  u  p  i  d cat", "a s/t/u/p/i/d cat", "old m, o, r, o, n", "see l ~ o ~ s ~ e ~ r"]
    wide = toxicity.score(spark.createDataFrame(list(enumerate(apart)), "doc_id long, text string"), model)[0]
    assert wide.where("toxicity >= 0.3").count() == len(apart)
    texts = ["the m0r0n sat", "a s t u p i d cat", "old stuuupiiid mat", "T.R.A.S.H here", "l0ser", "the cat sat on a mat", "", None, "1 2 3 a b c", "well-known cat", "x" * 5000, "### of%%% a***"]
    rows = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)], "doc_id long, text string, toxicity double")
    out, c = toxicity.score(rows, model)
    got = [r[c] for r in out.orderBy("doc_id").collect()]
    assert c == "toxicity_" and all(x >= 0.3 for x in got[:5]) and all(x < 0.3 for x in got[5:])
    assert toxicity.score(rows.limit(0), model)[0].count() == 0


def test_no_labels(spark):
    docs, labels = corpus(spark)
    model = toxicity.train(docs.limit(20), labels.limit(0))
    out, c = toxicity.score(docs.limit(20), model)
    assert out.agg(F.max(c)).first()[0] < 0.01
    odd = spark.createDataFrame([(1, 1), (1, 0), (1, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    toxicity.train(docs.limit(0), odd)


def test_one_doubled_letter_is_read_as_the_decoder_reads_it(spark):
    r = np.random.default_rng(3)
    cost = toxicity.character_model(corpus(spark)[0])
    reader = toxicity.Reader(cost)
    words = []
    for _ in range(3000):
        w = list(r.choice(list("abcdeghlmnorstuy\u00e9"), r.integers(1, 9)))
        at = r.integers(0, len(w))
        words.append("".join(w[:at] + [w[at]] * 2 + w[at + 1:]))
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    s, e, _ = toxicity.runs(data != 32, np.array([0, len(data)]))
    several, one, out = reader._stretched(np.where(data == 32, 0, data).astype(np.uint8), s, e)
    dropped = dict(zip(one.tolist(), (out - s[one]).tolist(), strict=True))
    for i, w in enumerate(words):
        raw = w.encode()
        if i not in several and raw != toxicity.decode(raw, reader.costs):
            assert toxicity.decode(raw, reader.costs) == raw[:dropped[i]] + raw[dropped[i] + 1:], w
        elif i in dropped:
            raise AssertionError(w)
    assert len(dropped) > 100


def test_more_languages_than_a_word_has_bits(spark):
    r = np.random.default_rng(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [["".join(r.choice(list(letters), 7)) for _ in range(40)] for _ in range(130)]
    text = lambda k: " ".join(r.choice(words[k], 60))
    docs = spark.createDataFrame([(k, text(k), f"l{k:03}") for k in range(130) for _ in range(2)], "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert len(model.languages) == 130 and len(model.masks) == 3
    out, c = langid.identify(spark.createDataFrame([(k, text(k)) for k in range(130)], "doc_id long, text string"), model)
    assert out.where(F.col(c)["lang"] != F.format_string("l%03d", "doc_id")).count() == 0
