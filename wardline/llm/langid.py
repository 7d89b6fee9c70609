"""Language identification with bit-sliced n-gram filters.

One Bloom filter for all languages: each slot holds a bitmask of languages, and
the AND of an n-gram's slots is the set of languages that contain it.  A text's
hits are counted per language, corrected for the filter's false positives, and
the language with the most hits wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm.common import chunks, fresh, in_arrow, store

#: Slots of the filter, hash functions, and languages a word of a mask holds; a slot
#: has as many words as the languages need (8 MB for each).
SLOTS, HASHES, WORD = 1 << 20, 3, 63
#: A language contains an n-gram that makes up this share of its n-grams at
#: least, and this share of the highest such share of any language.
LEAST, OF_BEST = 1e-6, 0.1
UNKNOWN = "und"

# letters -> 1..58 (a-z, then folded bytes of other letters), the rest -> 0
_SYMBOL = np.zeros(256, np.uint32)
_SYMBOL[ord("a"):ord("z") + 1] = _SYMBOL[ord("A"):ord("Z") + 1] = np.arange(1, 27)
_SYMBOL[128:] = 27 + (np.arange(128) & 31)
_MULTIPLY = [0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35]


def grams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (24 bits) of the 4-grams within words, with one blank before and
    after each word, and for each row the number of codes before it."""
    n = len(offs) - 1
    c = np.zeros(len(data) + n + 3, np.uint32)
    at = np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offs))
    c[at] = _SYMBOL[data]
    code = c[:-3] << np.uint32(18) | c[1:-2] << np.uint32(12) | c[2:-1] << np.uint32(6) | c[3:]
    keep = np.flatnonzero((c[1:-2] != 0) & (c[2:-1] != 0))
    return code[keep], np.searchsorted(keep, offs + np.arange(n + 1))


def slots(code: np.ndarray) -> Iterator[np.ndarray]:
    """The places of each code in the filter."""
    shift = np.uint32(32 - (SLOTS.bit_length() - 1))
    for m in _MULTIPLY[:HASHES]:
        yield (code * np.uint32(m)) >> shift


def _slot_columns(code: Column) -> Column:
    shift = 32 - (SLOTS.bit_length() - 1)
    return F.array(*[F.shiftright((code.cast("decimal(20,0)") * m % 2**32).cast("long"), shift).cast("int") for m in _MULTIPLY[:HASHES]])


class Model:
    """Languages, filter (words of masks by slot), and per language the rate of
    false positives."""

    def __init__(self, languages: list[str], masks: np.ndarray):
        self.languages, self.masks = languages, masks
        self.wrong = np.array([float(np.mean((masks[i // WORD] >> (i % WORD)) & 1)) ** HASHES for i in range(len(languages))])

    def predict(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row the index of its language and the share of its n-grams
        that the language contains."""
        code, w = grams(data, offs)
        n = np.diff(w)
        best, share = np.zeros(len(n), np.int64), np.full(len(n), -1.0)
        places = list(slots(code))
        for k, word in enumerate(self.masks):
            mask = np.full(len(code), -1, np.int64)
            for s in places:
                mask &= word[s]
            for i in range(k * WORD, min((k + 1) * WORD, len(self.languages))):
                wrong = self.wrong[i]
                run = np.concatenate(([0], np.cumsum((mask >> (i % WORD)) & 1)))
                own = np.clip((run[w[1:]] - run[w[:-1]] - n * wrong) / (1 - min(wrong, 0.999)) / np.maximum(n, 1), 0, 1)
                best = np.where(own > share, i, best)
                share = np.maximum(share, own)
        return best, np.maximum(share, 0)


def train(docs: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """Count the 4-grams of all of ``docs`` by language (rows with a null
    language or text are skipped) and fill the filter.

    Tasks count their own rows; the counts are summed by n-gram, so no language,
    however large, meets in one task.  Only the filter's slots, at most
    ``SLOTS`` rows for every ``WORD`` languages, come to the driver.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def fold(language: str) -> None:
            codes, counts = (np.concatenate(x) for x in zip(*held[language], strict=True))
            order = np.argsort(codes, kind="stable")
            codes, counts = codes[order], counts[order]
            first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
            held[language] = [(codes[first], np.add.reduceat(counts, first))]

        for batch in batches:
            for rows, data, offs in chunks(batch, "text"):
                names = np.array(rows.column(0).to_pylist(), object)
                code, w = grams(data, offs)
                of = np.repeat(np.arange(len(names)), np.diff(w))
                for language in set(names):
                    own = np.sort(code[(names == language)[of]])
                    if len(own):
                        first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                        held.setdefault(language, []).append((own[first], np.diff(np.append(first, len(own)))))
                        if len(held[language]) > 8:
                            fold(language)
        for language in held:
            fold(language)
            (codes, counts), = held[language]
            for lo in range(0, len(codes), 50_000):
                part = codes[lo:lo + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([language] * len(part)), pa.array(part.astype(np.int32)), pa.array(counts[lo:lo + 50_000].astype(np.int64))], names=["lang", "code", "n"])

    labelled = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).dropna()
    counts = store(labelled.transform(in_arrow, count, "lang string, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")), "langid-grams")
    totals = sorted(((r["lang"], r["n"]) for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()), key=lambda r: (-r[1], r[0]))
    masks = np.zeros((-(-len(totals) // WORD), SLOTS), np.int64)
    if totals:
        rate = F.col("n") / F.create_map(*[F.lit(x) for r in totals for x in r])[F.col("lang")]
        number = F.create_map(*[F.lit(x) for i, (name, _) in enumerate(totals) for x in (name, i)])[F.col("lang")]
        best = (counts.select("code", rate.alias("rate"), number.alias("number")).groupBy("code")
                .agg(F.max("rate").alias("best"), F.collect_list(F.struct("rate", "number")).alias("of")))  # one entry per language
        own = best.select("code", F.explode(F.filter("of", lambda x: (x["rate"] >= LEAST) & (x["rate"] >= F.col("best") * OF_BEST))).alias("x"))
        bit = F.expr(f"shiftleft(1L, x.number % {WORD})")
        contained = own.select("code", F.floor(F.col("x.number") / WORD).cast("int").alias("word"), bit.alias("bit")).groupBy("code", "word").agg(F.bit_or("bit").alias("mask"))
        filled = contained.select(F.explode(_slot_columns(F.col("code"))).alias("slot"), "word", "mask").groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")).toArrow()
        word, slot, mask = (filled.column(c).to_numpy() for c in ("word", "slot", "mask"))
        masks[word, slot] = mask
    return Model([name for name, _ in totals], masks)


def identify(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one more column (its name is returned): struct of ``lang``
    (``und`` for texts that are null or have no letter) and ``score`` (share of
    the text's n-grams that the language contains, 0 to 1).

    Ties, and texts of single letters only, go to the language with more
    training text.  Row by row, no shuffle; the filter has a fixed size.
    """
    column = fresh(docs.columns, "language")
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])
    letter = fresh(docs.columns, "letter")
    marked = docs.withColumn(letter, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))).withColumn(column, F.lit(None).cast(kind))
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.masks))
    at = marked.columns.index(letter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        names = m.languages or [UNKNOWN]
        for batch in batches:
            for rows, data, offs in chunks(batch, text):
                best, share = m.predict(data, offs)
                ok = rows.column(at).to_pylist()
                out = pa.StructArray.from_arrays([
                    pa.array([names[b] if o else UNKNOWN for b, o in zip(best.tolist(), ok, strict=True)], pa.string()),
                    pa.array(np.where(ok, share, 0.0))], ["lang", "score"])
                yield rows.set_column(rows.num_columns - 1, rows.schema.field(rows.num_columns - 1), out)

    return marked.transform(in_arrow, run, marked.schema).drop(letter), column


def held_out(key: Column) -> Column:
    """The rows that no model may learn from: crc32 of the key's text mod 4 is 2
    (a null key counts as the empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 4 == 2
