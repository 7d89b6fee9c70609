"""Benchmark decontamination: hashed n-gram windows of the test items are
broadcast, the documents' windows are looked up, hits are verified word by
word, and spans or documents are removed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm.common import ALNUM, chunks, fresh, gram_hashes, in_arrow, runs, span_hashes, store

WINDOW = 10
#: Windows broadcast at once; more are taken in several passes over the documents.
MAX_WINDOWS = 400_000

def hit_type(item: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(item)),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])


def item_type(benchmark: DataFrame) -> T.DataType:
    """How item ids are kept: integers as long, all others as strings."""
    return T.LongType() if isinstance(benchmark.schema["item_id"].dataType, T.IntegralType) else T.StringType()


def _words(data: np.ndarray, offs: np.ndarray) -> tuple:
    norm = ALNUM[data]
    s, e, w = runs(norm != 0, offs)
    return norm, s, e, w, span_hashes(norm, s, e)


def _span_text(norm: np.ndarray, s: int, e: int) -> bytes:
    return b" ".join(x for x in norm[s:e].tobytes().split(b"\0") if x)


def windows(benchmark: DataFrame, k: int = WINDOW) -> DataFrame:
    """``benchmark(item_id, text)`` -> distinct ``(h, words, text, items)``: the
    items' windows of k words, or the whole item if it has fewer but not none."""
    kind = item_type(benchmark)
    of = pa.int64() if isinstance(kind, T.LongType) else pa.string()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in chunks(batch, "text"):
                norm, s, e, w, wh = _words(data, offs)
                out: list[tuple] = []
                for item, lo, hi in zip(rows.column(0).to_pylist(), w[:-1].tolist(), w[1:].tolist(), strict=True):
                    n = min(k, hi - lo)
                    if n:
                        hs = gram_hashes(wh[lo:hi], n).view(np.int64).tolist()
                        out += [(h, n, _span_text(norm, s[i], e[i + n - 1]).decode(errors="replace"), item) for i, h in enumerate(hs, lo)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.string(), of), strict=True)], names=["h", "words", "text", "item_id"])

    return (benchmark.select(F.col("item_id").cast(kind), F.col("text").cast("string"))
            .transform(in_arrow, cut, f"h long, words int, text string, item_id {kind.simpleString()}")
            .groupBy("h", "words", "text").agg(F.array_sort(F.collect_set("item_id")).alias("items")))


class _Index:
    """Look-up over one broadcast share of the windows."""

    def __init__(self, rows: list[tuple]):
        self.by: dict[tuple, list] = {}
        for h, n, text, items in rows:
            self.by.setdefault((n, h), []).append((text.encode(), items))
        self.lengths = {}
        for n in sorted({n for n, _ in self.by}):
            hs = np.unique(np.array([h for m, h in self.by if m == n], np.int64).view(np.uint64))
            bits = np.zeros(1 << max(16, min(24, (len(hs) * 16).bit_length())), bool)
            bits[hs & np.uint64(len(bits) - 1)] = True
            self.lengths[n] = hs, bits

    def scan(self, data: np.ndarray, offs: np.ndarray) -> tuple:
        norm, s, e, w, wh = _words(data, offs)
        cover, items = np.zeros(len(s) + 1, np.int32), {}
        for n, (hs, bits) in self.lengths.items():
            g = gram_hashes(wh, n)
            at = np.flatnonzero(bits[g & np.uint64(len(bits) - 1)])
            at = at[hs[np.minimum(np.searchsorted(hs, g[at]), len(hs) - 1)] == g[at]]
            doc = np.searchsorted(w, at, "right") - 1
            at, doc = at[at + n <= w[doc + 1]], doc[at + n <= w[doc + 1]]
            for i, d, h in zip(at.tolist(), doc.tolist(), g[at].view(np.int64).tolist(), strict=True):
                found = _span_text(norm, s[i], e[i + n - 1])
                for text, ids in self.by[n, h]:
                    if text == found:
                        cover[i] += 1
                        cover[i + n] -= 1
                        items.setdefault(d, set()).update(ids)
        hit = np.cumsum(cover[:-1]) > 0
        return s, e, w, hit, items


def _pass(index, text: str, column: str, item: T.DataType):
    """mapInArrow function that adds one share's hits to struct ``column``."""
    of = pa.int64() if isinstance(item, T.LongType) else pa.string()
    kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(of)), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = _Index(index.value)
        for batch in batches:
            for rows, data, offs in chunks(batch, text):
                at = rows.schema.get_field_index(column)
                before = rows.column(at).to_pylist()
                s, e, w, hit, items = look.scan(data, offs)
                out = []
                for d, was in enumerate(before):
                    lo, hi = int(w[d]), int(w[d + 1])
                    own = hit[lo:hi]
                    if was and was["spans"]:
                        ws, we = s[lo:hi] - offs[d], e[lo:hi] - offs[d]
                        for x in was["spans"]:
                            own |= (ws >= x["start"]) & (we <= x["end"])
                    n = int(np.count_nonzero(own))
                    spans = []
                    if n:
                        edge = np.diff(np.concatenate(([0], own.view(np.int8), [0])))
                        spans = [{"start": int(s[lo + a] - offs[d]), "end": int(e[lo + b - 1] - offs[d])} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]
                    ids = items.get(d, set()) | set(was["items"] if was else ())
                    out.append({"n_words": hi - lo, "n_hit": n, "items": sorted(x for x in ids if x is not None), "spans": spans})
                yield rows.set_column(at, rows.schema.field(at), pa.array(out, kind))
    return scan


def annotate(docs: DataFrame, benchmark: DataFrame, text: str = "text", k: int = WINDOW) -> tuple[DataFrame, str]:
    """``docs`` with one more column (its name is returned): struct of
    ``n_words, n_hit`` (words inside occurrences of a window), ``items`` (sorted
    ids of items with an occurring window) and ``spans`` (byte ranges of the
    text's maximal runs of hit words).

    Null or empty texts have no words; items without words have no windows; a
    null item_id marks words but is in no list; ids that are no integers are listed
    as strings.  Repeated rows are judged each
    by itself.  The windows are broadcast ``MAX_WINDOWS`` at a time, so the
    broadcast is bounded for any benchmark; each further pass works on a
    written table.
    """
    spark = docs.sparkSession
    column = fresh(docs.columns, "hits")
    item = item_type(benchmark)
    out = docs.withColumn(column, F.lit(None).cast(hit_type(item)))
    grams = store(windows(benchmark, k), "windows")
    shares = max(1, -(-grams.count() // MAX_WINDOWS))
    for i in range(shares):
        rows = grams.where(F.pmod("h", F.lit(shares)) == i).collect()
        index = spark.sparkContext.broadcast([(r.h, r.words, r.text, r["items"]) for r in rows])
        if i:
            out = store(out, "decontaminate")
        out = out.transform(in_arrow, _pass(index, text, column, item), out.schema)
    return out, column


def remove_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", max_hit: int = 0, k: int = WINDOW) -> DataFrame:
    """The documents with at most ``max_hit`` hit words, unchanged."""
    out, c = annotate(docs, benchmark, text, k)
    return out.where(F.col(c)["n_hit"] <= max_hit).drop(c)


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the bytes of ``spans``; where one was, a line break."""
    raw = F.encode(text, "UTF-8")
    cut = F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("kept")),
                      lambda a, s: F.struct(s["end"].alias("at"), F.array_append(a["kept"], F.decode(
                          F.substr(raw, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), "UTF-8")).alias("kept")),
                      lambda a: F.array_append(a["kept"], F.decode(F.substr(raw, (a["at"] + 1).cast("int")), "UTF-8")))
    return F.when(F.size(spans) > 0, F.array_join(cut, "\n")).otherwise(text)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", k: int = WINDOW) -> DataFrame:
    """All documents, without the spans of hit words."""
    out, c = annotate(docs, benchmark, text, k)
    return out.withColumn(text, without_spans(F.col(text), F.col(c)["spans"])).drop(c)
