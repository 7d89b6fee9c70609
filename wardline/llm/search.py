"""Ranked lexical search of a few items in all documents.

The terms of all items make one Aho-Corasick automaton, each with a guard before and
behind it, so that only whole terms match.  It is broadcast and reads the texts
themselves; no index of the documents is built.  A first scan counts in how many
documents each term is, a second one scores: an automaton's output is a term, a term
belongs to items, and each task keeps its best documents of every item.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import ALNUM, CHUNK, chunks, in_arrow, runs, store

#: Pairs of an item and a term that are broadcast and scanned for at a time; more
#: items take more scans.  An item is never split, so one with more terms than this
#: is a block of its own.
BLOCK = 200_000
#: Scores of a block of documents held at once, and scores that a task gathers
#: before it throws away all but the best of each item.
CELLS, PENDING = 1 << 21, 1 << 19
#: Up to so many terms of an item all sums of scores are whole numbers in doubles:
#: a term adds less than 1000 * ln(2^64) * 10^6.
EXACT = 200_000
GUARD = 32


class Automaton:
    """Counts whole terms in texts; a term is known by its place in ``terms``."""

    def __init__(self, terms: list[bytes]):
        self.words = ahocorasick.Automaton()
        guard = chr(GUARD)
        for i, term in enumerate(terms):  # a byte is a character: no text is malformed
            self.words.add_word(guard + term.decode("latin-1") + guard, i)
        self.size = len(terms)
        if terms:
            self.words.make_automaton()

    def _matches(self, norm: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(offs) - 1
        text = np.full(len(norm) + n + 1, GUARD, np.uint8)
        letter = np.flatnonzero(norm)
        row = np.searchsorted(offs, letter, "right") - 1
        text[letter + row + 1] = norm[letter]
        found = np.fromiter(itertools.chain.from_iterable(self.words.iter(text.tobytes().decode("latin-1"))), np.int64).reshape(-1, 2)
        return np.searchsorted(offs[:-1] + np.arange(n), found[:, 0] - 1, "right") - 1, found[:, 1]

    def count(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms of each row, known or not, with repeats; then row, term and count
        of each known one, in order.  A long row is read in pieces cut between terms."""
        norm = ALNUM[data]
        n = np.diff(runs(norm != 0, offs)[2])
        parts = [(norm, offs)]
        if len(offs) == 2 and len(norm) > CHUNK:
            between = np.flatnonzero(norm == 0)
            at = np.searchsorted(between, np.arange(CHUNK, len(norm), CHUNK))
            cuts = np.concatenate(([0], np.unique(between[at[at < len(between)]]), [len(norm)]))
            parts = [(norm[a:b], np.array([0, b - a])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        keys = np.zeros(0, np.int64)
        times = np.zeros(0, np.int64)
        for part, places in parts if self.size else ():
            row, term = self._matches(part, places)
            key, many = np.unique(row * self.size + term, return_counts=True)
            keys, times = np.concatenate((keys, key)), np.concatenate((times, many))
        if len(parts) > 1:
            keys, back = np.unique(keys, return_inverse=True)
            times = np.bincount(back, times, len(keys)).astype(np.int64)
        size = max(1, self.size)
        return n, keys // size, keys % size, times


class Scorer:
    """Scores of documents for the items of a block, from counts of terms."""

    def __init__(self, items: int, item: np.ndarray, term: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int):
        self.items, self.weights, self.n_docs, self.n_terms = items, weights, n_docs, n_terms
        per_term = np.bincount(term, minlength=len(weights))
        most = np.bincount(item, minlength=items).max(initial=0)
        self.kind = np.float64 if most <= EXACT else np.int64
        # terms of many items go through a matrix, the others through their lists of items
        common = np.flatnonzero(per_term * 16 > items)
        self.column = np.full(len(weights), -1)
        self.column[common] = np.arange(len(common))
        inside = self.column[term] >= 0
        self.matrix = np.zeros((len(common), items), self.kind)
        self.matrix[self.column[term[inside]], item[inside]] = 1
        order = np.argsort(term[~inside], kind="stable")
        self.of = item[~inside][order]
        per_term[common] = 0
        self.per_term = per_term
        self.first = np.cumsum(per_term) - per_term

    def scores(self, docs: int, n: np.ndarray, row: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Whole numbers, a row for each of ``docs`` documents with ``n`` terms."""
        m = 50 + (50 * n * self.n_docs) // self.n_terms
        part = self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[row]))
        many = self.column[term] >= 0
        left = np.zeros((docs, len(self.matrix)), self.kind)
        left[row[many], self.column[term[many]]] = part[many]
        out = left @ self.matrix
        row, term, part = row[~many], term[~many], part[~many]
        times = self.per_term[term]
        place = np.repeat(self.first[term] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        key = np.repeat(row, times) * self.items + self.of[place]
        if self.kind is np.float64:
            out += np.bincount(key, np.repeat(part, times), docs * self.items).reshape(out.shape)
        else:
            np.add.at(out.reshape(-1), key, np.repeat(part, times))
        return out


def _best(table: pa.Table, top: int) -> pa.Table:
    """The ``top`` rows of each item, best first; equal scores by document."""
    order = pc.sort_indices(table, [("item", "ascending"), ("score", "descending"), ("doc", "ascending")], null_placement="at_start")
    table = table.take(order).combine_chunks()
    item = table.column("item").to_numpy()
    first = np.searchsorted(item, item)
    return table.filter(pa.array(np.arange(len(item)) - first < top))


def item_terms(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """``(item, term binary)``: the distinct terms of each item; rows that repeat an
    id are one item."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in chunks(batch, "text"):
                norm = ALNUM[data]
                s, e, w = runs(norm != 0, offs)
                of = np.repeat(np.arange(len(rows)), np.diff(w))
                for lo in range(0, len(s), 100_000):
                    terms = [norm[a:b].tobytes() for a, b in zip(s[lo:lo + 100_000].tolist(), e[lo:lo + 100_000].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(of[lo:lo + 100_000])), pa.array(terms, pa.binary())], names=["item", "term"])

    rows = items.select(F.col(item).alias("item"), F.col(text).cast("string").alias("text"))
    return rows.transform(in_arrow, split, f"item {rows.schema['item'].dataType.simpleString()}, term binary").distinct()


def rank(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
         top: int = 50, block: int = BLOCK) -> DataFrame:
    """``(item_id, rank int, doc_id, score long)``: for each item its ``top``
    documents with a score above 0, best first.

    Terms are runs of letters and digits (ASCII) and of all other non-ASCII
    characters, lower-cased A-Z.  With N documents that have terms, L terms in all of
    them, df documents with a term, n terms in a document and tf of them one term, an
    item's term adds ``w * ((10^9 * tf) div (1000 * tf + 20 * m))``, where
    ``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` and
    ``m = 50 + (50 * n * N) div L``.  Equal scores are in order of the document's id
    (null first); every row of ``docs`` is a document, so a repeated id may come twice.
    Rows that repeat an item's id are one item (null is an id).  Null and empty texts
    have no terms; items without terms, and empty tables, give no rows.

    A task returns ``top`` rows an item at most; these are reduced by parts of the
    documents before they meet by item.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text"))
    kind = texts.schema["doc"].dataType.simpleString()
    pairs = store(item_terms(items, item, item_text), "search-terms")
    blocks = -(-pairs.count() // block)
    found = spark.createDataFrame([], f"item {pairs.schema['item'].dataType.simpleString()}, doc {kind}, score long")
    for b in range(blocks):
        own = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).toArrow()
        if not len(own):
            continue
        ids = pa.chunked_array(own.column("item")).combine_chunks().dictionary_encode(null_encoding="encode")
        words = own.column("term").combine_chunks().dictionary_encode()
        n_items, terms = len(ids.dictionary), words.dictionary.to_pylist()
        item_of, term_of = ids.indices.to_numpy(), words.indices.to_numpy()
        shared = spark.sparkContext.broadcast(terms)

        def counts(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            machine = Automaton(shared.value)
            df = np.zeros(machine.size, np.int64)
            with_terms = all_terms = 0
            for batch in batches:
                for _, data, offs in chunks(batch, "text"):
                    n, _, term, _ = machine.count(data, offs)
                    df += np.bincount(term, minlength=machine.size)
                    with_terms += np.count_nonzero(n)
                    all_terms += int(n.sum())
            at = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([-2, -1], at)), pa.int32()), pa.array(np.concatenate(([with_terms, all_terms], df[at])), pa.int64())], names=["term", "n"])

        held = {r["term"]: r["n"] for r in texts.select("text").transform(in_arrow, counts, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
        n_docs, n_terms = held.get(-2, 0), held.get(-1, 0)
        if not n_docs:
            continue
        weights = np.array([math.floor(1000 * math.log((2.0 * n_docs + 2) / (2 * held.get(i, 0) + 1))) for i in range(len(terms))], np.int64)
        block_of = spark.sparkContext.broadcast((n_items, item_of, term_of, weights, n_docs, n_terms))

        def best(batches: Iterator[pa.RecordBatch], shared=shared, block_of=block_of) -> Iterator[pa.RecordBatch]:
            machine, scorer = Automaton(shared.value), Scorer(*block_of.value)
            least = np.ones(scorer.items)  # a score below an item's cannot be among its best
            held: list[pa.Table] = []
            size = 0

            def shrink() -> pa.Table:
                table = _best(pa.concat_tables(held), top)
                of, many = np.unique(table.column("item").to_numpy(), return_counts=True)
                last = table.column("score").to_numpy()[np.cumsum(many) - 1]
                least[of[many == top]] = last[many == top]
                return table

            for batch in batches:
                for rows, data, offs in chunks(batch, "text"):
                    n, row, term, tf = machine.count(data, offs)
                    step = max(1, CELLS // max(scorer.items, len(scorer.matrix)))
                    for lo in range(0, len(n), step):
                        a, z = np.searchsorted(row, (lo, lo + step))
                        if a == z:
                            continue
                        score = scorer.scores(min(step, len(n) - lo), n[lo:lo + step], row[a:z] - lo, term[a:z], tf[a:z])
                        d, i = np.nonzero(score >= least)
                        held.append(pa.table({"item": pa.array(i.astype(np.int32)), "doc": rows.column(0).take(pa.array(d + lo)), "score": pa.array(score[d, i].astype(np.int64))}))
                        size += len(d)
                        if size > PENDING:
                            held, size = [shrink()], 0
            if held:
                yield from shrink().to_batches(max_chunksize=50_000)

        names = spark.createDataFrame(pa.table({"at": pa.array(np.arange(n_items), pa.int32()), "item": ids.dictionary}))
        ranked = texts.transform(in_arrow, best, f"item int, doc {kind}, score long").withColumnRenamed("item", "at")
        found = found.unionAll(ranked.join(F.broadcast(names), "at").select("item", "doc", "score"))
    order = (F.desc("score"), F.col("doc").asc_nulls_first())
    part = found.withColumn("part", F.pmod(F.xxhash64("doc"), F.lit(64)))
    part = part.withColumn("r", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("r") <= top)
    last = part.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    return last.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")
