import re

import numpy as np

import corpus_pipeline
from tests.llm import brute
from wardline.llm.packing import token_ids

SF = "/root/testdata/sf0.001"


def test_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = [d for d in docs if d[1] and re.search(r"[^\W\d_]", d[1])]
    left = brute.without_lines(left)
    near = brute.near_documents(left, 80)
    left = [d for d in left if near[d[0]] == d[0]]
    bad = brute.contaminated(left, items)
    left = [d for d in left if not bad[d[0]][1]]
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert set(got.doc_id) == {d for d, _ in left} and len(left) < len(docs)
    for doc, text in left:
        assert set(got[got.doc_id == doc].doc_tokens) == {len(token_ids(text)) + 1} == {got[got.doc_id == doc].length.sum()}
    sizes = got.groupby("sequence_id").length.sum()
    assert (np.log2(sizes) % 1 == 0).all() and sizes.max() <= 1024


def test_stages_keep_the_columns_and_odd_rows(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(1, "the cat sat", "en", "s", 11), (2, None, None, None, None), (None, "a null key is kept here", "en", None, 3), (3, "", "en", "s", 0), (4, "12 34", "en", "s", 5), (1, "the cat sat", "en", "s", 11)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == schema.names, name
    assert sorted((r["doc_id"] or 0) for r in docs.collect()) == [0, 1, 1]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], schema), SF).count() == 0


def test_foreign_texts_go_and_clean_ones_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    foreign = ["Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
               "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.",
               "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti.",
               "def f(x): return [y**2 for y in range(x) if y % 2 == 0]; import os, sys", "a95f8013a8e106335957369e74af1c836a0da03c 841d82b07cb9b9f1"]
    clean = ["the", "the of and that", "der die und", "and the"]
    extra = spark.createDataFrame([(10**9 + i, t, None, "x", len(t)) for i, t in enumerate(foreign + clean)], docs.schema)
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, docs.unionAll(extra), "").select("doc_id").collect()}
    assert not kept & {10**9 + i for i in range(len(foreign))}
    assert {10**9 + len(foreign) + i for i in range(len(clean))} <= kept
    assert {r["doc_id"] for r in docs.where("text rlike '[a-z]'").select("doc_id").collect()} <= kept


def test_the_registry_has_every_query():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
