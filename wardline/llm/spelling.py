"""Grouping of spelling variants in the vocabulary of a corpus.

Two words are near if one inserted, deleted or replaced character parts them.  Every
word's neighbourhood (its deletions and replacements; an insertion is a deletion of
the other word) is generated by hash alone, in arrays, and probed against blocked
Bloom filters of the vocabulary, one for each length, that are broadcast.  Only the
positives become text, are shuffled and joined with the vocabulary, which removes
the false ones.  A word's form is its most frequent near word; forms are followed to
their roots by pointer doubling.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import ASCII_LOWER, chunks, in_arrow, mix, runs, store

#: Code points of the shortest word, and occurrences of the rarest.
SHORTEST, LEAST = 7, 2
#: A form occurs at least so many times as often as its word.
RATIO = 10
#: One in so many occurrences of a word has a character taken out.
TYPO = 31
#: Bits that a filter has for a word, bits that a word sets in its block, and bytes
#: of the filters broadcast at a time: a larger vocabulary takes more rounds, each
#: with the filters of one slice of it.
BITS, SET, BYTES = 16, 6, 1 << 25
#: Lengths from here on share filters.
LENGTHS = 128
#: Hashes of a neighbourhood that are held at once.
HELD = 1 << 18

_P = np.uint64(0x9E3779B97F4A7C15)
_PINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_VALUE = np.random.default_rng(0xB100).integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)

# ------------------------------------------------------------------ words

_WORD = np.zeros(256, bool)
_WORD[65:91] = _WORD[97:123] = True


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


_CRC = _crc_table()


def crc32_of(before: np.ndarray, data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """``zlib.crc32(data[s:e], before)`` of many short spans at once."""
    out = np.zeros(len(s), np.uint32)
    size = e - s
    for i in np.flatnonzero(size > 64).tolist():
        out[i] = zlib.crc32(data[s[i]:e[i]], int(before[i]))
    order = np.argsort(-np.where(size > 64, 0, size), kind="stable")
    left = np.sort(np.where(size > 64, 0, size))
    state, at = before[order] ^ np.uint32(0xFFFFFFFF), s[order]
    for j in range(int(left[-1]) if len(left) else 0):
        n = len(left) - int(np.searchsorted(left, j, "right"))
        now = state[:n]
        state[:n] = _CRC[(now ^ data[at[:n] + j]) & np.uint32(0xFF)] ^ (now >> np.uint32(8))
    short = size[order] <= 64
    out[order[short]] = state[short] ^ np.uint32(0xFFFFFFFF)
    return out


def words(data: np.ndarray, offs: np.ndarray, keys: list[str]) -> pa.Array:
    """The words of texts with repeats, as strings, after the typos.

    A word is a run of A-Z, a-z and U+00C0 to U+00FF, which UTF-8 writes as byte C3
    and one of 80 to BF; A-Z are lower-cased."""
    low = ASCII_LOWER[data]
    on = _WORD[data]
    two = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0xC0))
    on[two] = on[two + 1] = True
    s, e, w = runs(on, offs)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(w))
    first = on & ((data < 0x80) | (data == 0xC3))  # bytes that begin a character of a word
    points = np.concatenate(([0], np.cumsum(first)))
    long = np.flatnonzero(points[e] - points[s] >= SHORTEST)
    s, e, row = s[long], e[long], row[long]
    n = points[e] - points[s]
    before = np.array([zlib.crc32(f"{k}:".encode()) for k in keys], np.uint32)
    h = crc32_of(before[row], low, s, e).astype(np.int64)
    keep = np.ones(len(data), bool)
    cut = np.flatnonzero(h % TYPO == 0)
    starts = np.flatnonzero(first)
    at = starts[points[s[cut]] + h[cut] % n[cut]]
    keep[at] = False
    keep[at[data[at] >= 0x80] + 1] = False
    n[cut] -= 1
    long = np.flatnonzero(n >= SHORTEST)
    s, e = s[long], e[long]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[s] = 1
    inside[e] -= 1  # runs never touch
    flat = low[(np.cumsum(inside[:-1]) > 0) & keep]
    kept = np.concatenate(([0], np.cumsum(keep)))
    ends = np.concatenate(([0], np.cumsum(kept[e] - kept[s])))
    return pa.Array.from_buffers(pa.large_string(), len(s), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(flat.tobytes())])


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``(word, n long)``: the distinct words of all texts and how often they occur,
    those of fewer than ``least`` occurrences left out.  Tasks count their own."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for rows, data, offs in chunks(batch, "text"):
                if len(data):
                    found = pc.value_counts(words(data, offs, rows.column(0).to_pylist()))
                    held.append(pa.table({"word": found.field(0), "n": found.field(1)}))
            if held:
                total = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
                yield from pa.table({"word": total.column("word").cast(pa.string()), "n": total.column("n_sum")}).to_batches(max_chunksize=50_000)

    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.transform(in_arrow, count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# ---------------------------------------------------------------- filters


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of equal length: their places in ``column`` and their code points, a
    row each (all are below 256)."""
    data = column.cast(pa.large_binary())
    offs = np.frombuffer(data.buffers()[1], np.int64)[data.offset:data.offset + len(data) + 1]
    raw = np.frombuffer(data.buffers()[2], np.uint8)[offs[0]:offs[-1]] if offs[-1] > offs[0] else np.zeros(0, np.uint8)
    begins = raw < 0xC0
    begins[1:] &= raw[:-1] != 0xC3
    begins |= raw == 0xC3
    points = np.where(raw == 0xC3, np.concatenate((raw[1:], [0])) + 0x40, raw).astype(np.uint8)[begins]
    edge = np.concatenate(([0], np.cumsum(begins)))[offs - offs[0]]
    size = np.diff(edge)
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        yield at, points[edge[at][:, None] + np.arange(n)]


def to_strings(points: np.ndarray, size: int) -> pa.Array:
    """Rows of ``size`` code points below 256 as strings."""
    flat = points.reshape(-1)
    wide = flat >= 0x80
    at = np.arange(len(flat)) + np.cumsum(wide)
    out = np.empty(len(flat) + int(wide.sum()), np.uint8)
    out[at] = np.where(wide, (flat & 0x3F) | 0x80, flat)
    out[at[wide] - 1] = 0xC0 | (flat[wide] >> 6)
    ends = np.concatenate(([0], (at + 1).reshape(len(points), size)[:, -1] if size else np.zeros(len(points), np.int64)))
    return pa.Array.from_buffers(pa.large_string(), len(points), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes())]).cast(pa.string())


def _powers(n: int) -> np.ndarray:
    up = np.full(n + 1, _P, np.uint64)
    up[0] = 1
    return np.multiply.accumulate(up)


def shard(length: int) -> int:
    return length if length < LENGTHS else LENGTHS + length % LENGTHS


class Filters:
    """Blocked Bloom filters by length, all in one array of 64-bit words; a word's
    bits are in one block of 512."""

    def __init__(self, sizes: dict[int, int], rounds: int = 1, now: int = 0):
        self.rounds, self.now = rounds, now
        self.blocks = {k: max(1, -(-n * BITS // (512 * rounds))) for k, n in sorted(sizes.items())}
        self.first, total = {}, 0
        for k, b in self.blocks.items():
            self.first[k] = total
            total += b
        self.size = total * 8

    def places(self, key: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each of the SET bits of hashes ``key``: 64-bit word and bit."""
        k = shard(length)
        block = ((key >> np.uint64(32)) * np.uint64(self.blocks[k]) >> np.uint64(32)).astype(np.int64) + self.first[k]
        bits = mix(key ^ np.uint64(0x51F7))
        for j in range(SET):
            part = (bits >> np.uint64(9 * j)) & np.uint64(511)
            yield block * 8 + (part >> np.uint64(6)).astype(np.int64), part & np.uint64(63)

    def own(self, key: np.ndarray) -> np.ndarray:
        """Whether a hash belongs to the words of this round."""
        return (key & np.uint64(0xFFFF)) % np.uint64(self.rounds) == np.uint64(self.now)

    def holds(self, bitmap: np.ndarray, key: np.ndarray, length: int) -> np.ndarray:
        """Places of the hashes that may be of words."""
        if shard(length) not in self.blocks:
            return np.zeros(0, np.int64)
        at = np.flatnonzero(self.own(key)) if self.rounds > 1 else np.arange(len(key))
        left = key[at]
        k = shard(length)
        block = ((left >> np.uint64(32)) * np.uint64(self.blocks[k]) >> np.uint64(32)).astype(np.int64) + self.first[k] << 3
        bits = mix(left ^ np.uint64(0x51F7))
        for j in range(SET):
            part = (bits >> np.uint64(9 * j)) & np.uint64(511)
            on = np.flatnonzero(bitmap[block + (part >> np.uint64(6)).astype(np.int64)] >> (part & np.uint64(63)) & np.uint64(1))
            at, block, bits = at[on], block[on], bits[on]
        return at


def hashes(points: np.ndarray) -> np.ndarray:
    """Sums of each row's values times powers, at the end of every prefix (first 0)."""
    n = points.shape[1]
    pre = np.zeros((len(points), n + 1), np.uint64)
    np.cumsum(_VALUE[points] * _powers(n)[:n], axis=1, out=pre[:, 1:])
    return pre


def neighbours(points: np.ndarray, alphabet: np.ndarray, filters: Filters, bitmap: np.ndarray) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Rows of words and the words one edit from them that the filters may hold:
    deletions, and replacements by a later character (the other word has the others)."""
    m, n = points.shape
    pre, up = hashes(points), _powers(n)
    whole = pre[:, -1]
    for lo in range(0, m, max(1, HELD // max(1, len(alphabet)))):
        part, rows = points[lo:lo + max(1, HELD // max(1, len(alphabet)))], whole[lo:lo + max(1, HELD // max(1, len(alphabet)))]
        for i in range(n):
            old = part[:, i]
            key = mix(rows[:, None] + (_VALUE[alphabet][None, :] - _VALUE[old][:, None]) * up[i])
            later = np.flatnonzero((alphabet[None, :] > old[:, None]).reshape(-1))
            at = later[filters.holds(bitmap, key.reshape(-1)[later], n)]
            if len(at):
                row, letter = np.divmod(at, len(alphabet))
                found = part[row].copy()
                found[:, i] = alphabet[letter]
                yield row + lo, to_strings(found, n)
    if shard(n - 1) in filters.blocks:
        for i in range(n):
            # a run of one character gives the same word wherever it is cut: the last one counts
            last = np.flatnonzero(points[:, i] != points[:, i + 1]) if i + 1 < n else np.arange(m)
            key = mix(pre[last, i] + (whole[last] - pre[last, i + 1]) * _PINV)
            row = last[filters.holds(bitmap, key, n - 1)]
            if len(row):
                yield row, to_strings(np.delete(points[row], i, 1), n - 1)


def near_pairs(words: DataFrame, limit: int = BYTES) -> DataFrame:
    """``(word, n, other, other_n)`` for each pair of near words of the table
    ``words(word, n)``, in one direction."""
    spark = words.sparkSession
    length = F.char_length("word")
    sized = F.when(length < LENGTHS, length).otherwise(LENGTHS + length % LENGTHS)
    sizes = {r["k"]: r["n"] for r in words.groupBy(sized.alias("k")).agg(F.count("*").alias("n")).collect()}  # 2 * LENGTHS rows at most
    rounds = max(1, -(-sum(sizes.values()) * BITS // (8 * limit)))
    found: DataFrame | None = None
    for now in range(rounds):
        filters = Filters(sizes, rounds, now)

        def fill(batches: Iterator[pa.RecordBatch], filters=filters) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                places, masks = [], []
                seen = np.zeros(256, bool)
                for _, points in by_length(batch.column(0)):
                    key = mix(hashes(points)[:, -1])
                    own = np.flatnonzero(filters.own(key))
                    seen[points[own].reshape(-1)] = True
                    for place, bit in filters.places(key[own], points.shape[1]):
                        places.append(place)
                        masks.append(np.uint64(1) << bit)
                at, mask = (np.concatenate(x) for x in (places, masks)) if places else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
                order = np.argsort(at, kind="stable")
                at, first = np.unique(at[order], return_index=True)
                mask = np.bitwise_or.reduceat(mask[order], first) if len(first) else mask
                letters = np.flatnonzero(seen)  # in places of their own, before the filters
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((-letters - 1, at))), pa.array(np.concatenate((np.ones(len(letters), np.int64), mask.view(np.int64))))], names=["place", "mask"])

        filled = words.select("word").transform(in_arrow, fill, "place long, mask long").groupBy("place").agg(F.bit_or("mask").alias("mask")).toArrow()
        place, mask = (filled.column(c).to_numpy() for c in ("place", "mask"))
        bitmap = np.zeros(filters.size, np.uint64)
        bitmap[place[place >= 0]] = mask[place >= 0].view(np.uint64)
        shared = spark.sparkContext.broadcast((filters, np.sort(-place[place < 0] - 1).astype(np.uint8), bitmap))

        def probe(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            filters, alphabet, bitmap = shared.value
            for batch in batches:
                for at, points in by_length(batch.column(0)):
                    for row, other in neighbours(points, alphabet, filters, bitmap):
                        yield pa.RecordBatch.from_arrays([*batch.select(["word", "n"]).take(pa.array(at[row])).columns, other], names=["word", "n", "other"])

        positives = words.select("word", "n").transform(in_arrow, probe, "word string, n long, other string")
        exact = positives.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
        found = exact if found is None else found.unionAll(exact)
    return found.select("word", "n", "other", "other_n")


# ------------------------------------------------------------------ groups


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, ratio: int = RATIO) -> DataFrame:
    """``(word, form, root, n long, n_near long, form_n long)`` for each word of the
    corpus (``vocabulary``).

    ``n_near`` counts its near words; ``form`` is the one of them that occurs most
    (ties: the smallest in code-point order) if it does so ``ratio`` times as often as
    the word at least, else null; ``root`` is where following forms ends.  Texts that
    are null or empty have no words; rows that repeat an id or a text are counted as
    they are; a null id counts as an empty one for the typos.
    """
    known = store(vocabulary(docs, key, text, least), "spelling-words")
    pairs = store(near_pairs(known), "spelling-pairs")
    both = pairs.unionAll(pairs.select("other", "other_n", "word", "n"))
    # few near words are as frequent as the most frequent one: names are compared among those only
    most = both.groupBy("word").agg(F.count("*").alias("n_near"), F.max("other_n").alias("most"), F.max("n").alias("n"))
    most = store(most, "spelling-near")
    wanted = most.where(F.col("most") >= F.col("n") * ratio).select("word", "most")
    forms = both.join(wanted, "word").where("other_n = most").groupBy("word").agg(F.min("other").alias("form"), F.first("most").alias("form_n"))
    forms = store(forms, "spelling-forms")
    roots = store(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:  # a form occurs more often than its word, so ways end, each round halves them
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        then = store(roots.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")), "spelling-roots")
        roots = then.select("word", "root")
        if then.where("on").isEmpty():
            break
    own = most.select("word", "n_near").join(forms, "word", "left").join(roots, "word", "left")
    return known.join(own, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
