"""The registered queries of the corpus operators and, where SQL can express
them, their DuckDB equivalents."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import chat, decontaminate, html_text, langid, lines, neardup, packing, pii, repeats, search, spelling, toxicity, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


@query()
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, len(w[i:i + 9]) AS n, array_to_string(w[i:i + 9], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, least(len(w), 1)) + 1)) AS i FROM b)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
hit AS (SELECT dw.doc_id, dw.n, dw.i, bw.item_id FROM dw JOIN bw USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items.s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside a benchmark item's windows."""
    out, c = decontaminate.annotate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    h = F.col(c)
    return out.select(
        "doc_id", h["n_words"].alias("n_words"), h["n_hit"].alias("n_hit"), F.size(h["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform(h["items"], lambda x: x.cast("string"))), ","), 256).alias("items_sha256"),
        (h["n_hit"] > 0).alias("contaminated"))


@query("""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
t AS (SELECT *, replace(replace(replace(text, '\\', '\\a'), '###', '\\b'), '</turn>', '\\c') AS body,
      lag(role, 1, '') OVER w || '>' || role NOT IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user') AS refused,
      lead(role) OVER w IS NULL AND role NOT IN ('assistant', 'user') AS ends FROM c
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, coalesce(min(turn) FILTER (refused), CASE WHEN bool_or(ends) THEN -1 END) IS NULL AS valid,
       count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + len(role) + 2 + len(body) + 9) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
""")
def op10_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted and read back from the output."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    chats = chat.format_chats(turns.unionByName(extra))
    back = F.array_join(F.transform(chat.read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.loss_text(F.col("formatted"), F.col("segments"))
    return chats.select(
        "conv_id", F.size(chat.read_back(F.col("formatted"))).cast("long").alias("n_turns"), F.sha2(back, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "valid")


@query()
def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group")


@query()
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    out, c = langid.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), F.col(c)["lang"].alias("lang_pred"), F.col(c)["score"].alias("score"))


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learnt from labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~langid.held_out(F.col("doc_id")))
    out, c = toxicity.score(docs, toxicity.train(docs, labels))
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), F.col(c).alias("score"), (F.col(c) >= 0.3).cast("int").alias("predicted"))


@query("""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pairs JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS d, doc_id AS r FROM d UNION SELECT reach.d, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a)
SELECT d AS doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r) AS component_id, d = min(r) AS kept
FROM reach LEFT JOIN n ON n.doc_id = d GROUP BY d
""")
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of near duplicates."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT * FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good AS a JOIN good AS b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS d, vec_id AS r FROM v UNION SELECT reach.d, link.b FROM reach JOIN link ON reach.r = link.a)
SELECT d AS vec_id, CAST((SELECT count(*) FROM link WHERE link.a = d) AS BIGINT) AS n_links, min(r) AS component_id, d = min(r) AS kept FROM reach GROUP BY d
""")
def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding with its links and its component."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query("""
WITH RECURSIVE l AS (SELECT doc_id, i - 1 AS line_no, lower(trim(s[i], ' ' || chr(9) || chr(11) || chr(12) || chr(13))) AS t
  FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents))),
o AS (SELECT * FROM l WHERE t <> ''),
u AS (SELECT t, row_number() OVER (ORDER BY t) AS id FROM (SELECT DISTINCT t FROM o)),
g AS (SELECT DISTINCT id, substring(t, i, 5) AS s FROM (SELECT id, t, unnest(range(1, greatest(len(t) - 4, 1) + 1)) AS i FROM u)),
n AS (SELECT id, count(*) AS n FROM g GROUP BY 1),
pairs AS (SELECT a.id AS a, b.id AS b, count(*) AS c FROM g AS a JOIN g AS b ON a.s = b.s AND a.id < b.id GROUP BY 1, 2),
link AS (SELECT a, b FROM pairs JOIN n AS x ON x.id = a JOIN n AS y ON y.id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT id AS d, id AS r FROM u UNION SELECT reach.d, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a),
c AS (SELECT d AS id, min(r) AS comp FROM reach GROUP BY 1),
w AS (SELECT doc_id, line_no, comp FROM o JOIN u USING (t) JOIN c USING (id)),
f AS (SELECT comp, min((doc_id, line_no)) AS first FROM w GROUP BY 1)
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, (doc_id, line_no) = first AS kept FROM w JOIN f USING (comp)
""")
def op6_dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document, and whether it is its component's first."""
    out = lines.near_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("key").alias("doc_id"), F.col("no").cast("long").alias("line_no"), "kept")


@query()
def op7_cut_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 100-byte strings that start earlier."""
    out, c = repeats.cut_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.col(c["removed"]).alias("n_removed"),
                      F.size(c["spans"]).cast("long").alias("n_spans"), F.sha2(F.col(c["kept"]), 256).alias("kept_sha256"))


@query("""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM benchmark),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
tf AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS t FROM d) SEMI JOIN b USING (t) GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln((2.0 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM tf GROUP BY 1), c),
part AS (SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS s FROM tf JOIN w USING (t), c),
score AS (SELECT item_id, doc_id, CAST(sum(s) AS BIGINT) AS score FROM part JOIN b USING (t) GROUP BY ALL HAVING sum(s) > 0)
SELECT item_id, CAST(row_number() OVER r AS INTEGER) AS rank, doc_id, score FROM score WINDOW r AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY rank <= 50
""")
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents for every benchmark item."""
    return search.rank(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


@query()
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with the spelling it is a variant of."""
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: the patterns' spans and those added."""
    def of_kind(k: int):  # of one parameter: to a second one, F.filter gives the place in the array
        return lambda s: s["kind"] == k

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out, c = pii.find(docs, pii.train(docs))
    found = F.col(c)
    counts = [F.size(F.filter(found["base"], of_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return out.select("doc_id", *counts, F.sha2(found["base_written"], 256).alias("base_sha256"), found["written"].alias("spans"),
                      F.size(found["added"]).cast("long").alias("n_added"))
