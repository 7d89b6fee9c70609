"""Near-duplicate documents with SetSketch registers.

A document's word shingles are points of a Poisson process that deals them to
registers; a register keeps its smallest value on an exponential scale, so that
equal registers are as likely as shared shingles.  Bands of registers propose
pairs, a likelihood over larger, smaller and equal registers estimates their
similarity, and what may be similar enough is verified on the full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import band_components, byte_table, chunks, dealt, fresh, gram_hashes, groups, in_arrow, in_blocks, mix, runs, sieve, span_hashes, store

SHINGLE = 5
#: Registers, rows of a band, base of the scale, and the chance that a register
#: stays empty because its minimum lies beyond the truncation.
REGISTERS, ROWS, BASE, BEYOND = 256, 8, 1.02, 1e-4
#: Standard errors that an estimate may lie under the threshold.
MARGIN = 4.0

#: Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; byte 0 is a letter here.
_WORD = byte_table(b"")
_WORD[0] = 255
_WORD[[9, 10, 11, 12, 13, 32]] = 0


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each row its distinct shingles of k words, hashed and sorted; with
    fewer words the whole sequence as one, without words none."""
    norm = _WORD[data]
    s, e, w = runs(norm != 0, offs)
    wh = span_hashes(norm, s, e)
    grams = gram_hashes(wh, k)
    for lo, hi in zip(w[:-1].tolist(), w[1:].tolist(), strict=True):
        if hi - lo >= k:
            own = np.sort(grams[lo:hi - k + 1])
            yield own[np.concatenate(([True], own[1:] != own[:-1]))]
        else:
            yield gram_hashes(wh[lo:hi], hi - lo) if hi > lo else np.zeros(0, np.uint64)


def registers(sets: list[np.ndarray], m: int = REGISTERS, base: float = BASE) -> np.ndarray:
    """SetSketch registers (uint16) of each set; 0 for the empty set.

    Every element emits a Poisson process of rate m whose points fall into random
    registers, so each register sees the minimum of n exponential values.  Points
    beyond a truncation that leaves a register empty with probability BEYOND are
    never made: about m (log m + 9) points for a set of any size."""
    n = np.array([len(x) for x in sets])
    least = np.full(len(sets) * m, np.inf)
    if n.sum():
        cut = (math.log(m) - math.log(BEYOND)) / np.maximum(n, 1)
        state, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
        at = np.zeros(len(state))
        while len(state):
            state = mix(state + np.uint64(0x9E3779B97F4A7C15))
            at = at - np.log(((state >> np.uint64(11)) + np.uint64(1)).astype(np.float64) * 2.0**-53) / m
            on = np.flatnonzero(at < cut[of])
            state, of, at = state[on], of[on], at[on]
            np.minimum.at(least, of * m + (mix(state) % np.uint64(m)).astype(np.int64), at)
    least = least.reshape(-1, m)
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(least) / math.log(base))
    # values up to exp(20) / n on this side of 1 stay positive
    return np.where(np.isfinite(least), np.clip(k + 200, 1, 65535), 0).astype(np.uint16)


def _likelihood_filter(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, threshold: float, base: float = BASE) -> np.ndarray:
    """Which pairs of register rows may have a similarity of ``threshold``: the
    sizes allow it and the maximum of the joint likelihood is not MARGIN standard
    errors below it."""
    u, v = na / (na + nb), nb / (na + nb)
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    grid = np.linspace(0, 1, 201)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (base - 1) / base) / math.log(base)

    up, down = p(u[:, None] - v[:, None] * grid), p(v[:, None] - u[:, None] * grid)
    with np.errstate(divide="ignore", invalid="ignore"):
        ll = (np.where(more[:, None], more[:, None] * np.log(up), 0) + np.where(less[:, None], less[:, None] * np.log(down), 0)
              + np.where(same[:, None], same[:, None] * np.log(np.maximum(1 - up - down, 1e-300)), 0))
    ll[grid[None, :] > np.minimum(u / v, v / u)[:, None] + 1e-9] = -np.inf
    best = grid[np.nan_to_num(ll, nan=-np.inf).argmax(1)]
    error = math.sqrt(threshold * (1 - threshold) / a.shape[1])
    return (best >= threshold - MARGIN * error) & (np.minimum(na, nb) >= np.maximum(na, nb) * (threshold - 1e-9))


def sketch(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id long, n int, digest binary, regs binary)`` for each row: size and
    digest of the shingle set, registers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in chunks(batch, "text"):
                sets = list(shingle_sets(data, offs))
                regs = registers(sets)
                # two independent sums over the set identify it
                digest = [int(np.sum(x, dtype=np.uint64)).to_bytes(8, "little") + int(np.sum(mix(x ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)).to_bytes(8, "little") for x in sets]
                yield pa.RecordBatch.from_arrays([
                    rows.column(0), pa.array([len(x) for x in sets], pa.int32()), pa.array(digest, pa.binary()),
                    pa.array([r.tobytes() for r in regs], pa.binary())], names=["id", "n", "digest", "regs"])

    return (docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
            .transform(in_arrow, run, "id long, n int, digest binary, regs binary"))


def _bands(classes: DataFrame, rows: int = ROWS) -> DataFrame:
    """``(id, band)``: one row for each band of registers, hashed with its number."""
    size = 2 * rows
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("regs", i * size + 1, size)) for i in range(REGISTERS // rows)])
    return classes.select("id", F.explode(keys).alias("band"))


def _estimate(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """The pairs ``(a, b)`` whose registers allow the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 1000):
                part = batch.slice(lo, 1000)
                ra, rb = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(len(part), -1) for c in (4, 5))
                na, nb = (part.column(c).to_numpy().astype(float) for c in (2, 3))
                keep = pa.array(_likelihood_filter(ra, rb, na, nb, threshold / 100))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(keep)

    a = classes.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra"))
    b = classes.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "ra", "rb")
    return both.transform(in_arrow, run, "a long, b long")


def _likely(t: pa.Table, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a group, a band's or two of its blocks', in different
    components whose sizes and registers allow the threshold and that share no
    earlier band."""
    x, y = t.column("x")[0].as_py(), t.column("y")[0].as_py()
    own, root, n = (t.column(c).to_numpy() for c in ("own", "root", "n"))
    n = n.astype(np.int64)
    regs = np.frombuffer(b"".join(t.column("regs").to_pylist()), np.uint16).reshape(len(t), -1)
    bands = regs.reshape(len(t), -1, ROWS)
    here = int((bands == bands[:1]).all(2).all(0).argmax())
    for lo in range(0, len(t), 64):
        i, j = ((root[lo:lo + 64, None] != root[None, :]) & (100 * np.minimum(n[lo:lo + 64, None], n) >= threshold * np.maximum(n[lo:lo + 64, None], n))).nonzero()
        i += lo
        keep = i < j if x == y else (own[i] == x) & (own[j] == y)
        i, j = i[keep], j[keep]
        if here:
            keep = ~(bands[i, :here] == bands[j, :here]).all(2).any(1)
            i, j = i[keep], j[keep]
        if len(i):
            near = _likelihood_filter(regs[i], regs[j], n[i].astype(float), n[j].astype(float), threshold / 100)
            yield i[near], j[near]


def _link_apart(apart: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str, threshold: int) -> DataFrame:
    """Links ``(a, b)`` between components among classes of one band.

    Bands are compared in blocks inside tasks, first by registers to find the
    classes that are in any likely pair, then those with their full sets; only
    links become rows, never pairs that are merely likely."""
    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, ["band", "x", "y"]):
            on = np.zeros(len(t), bool)
            for i, j in _likely(t, threshold):
                on[i] = on[j] = True
            if on.any():
                yield from t.select(["band", "id", "root"]).filter(pa.array(on)).to_batches()

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, ["band", "x", "y"]):
            sets = [_unpack(s) for s in t.column("s").to_pylist()]
            ids = t.column("id").to_numpy()
            for i, j in _likely(t, threshold):
                keep = np.array([_similar(sets[p], sets[q], threshold) for p, q in zip(i.tolist(), j.tolist(), strict=True)], bool)
                a, b = ids[i[keep]], ids[j[keep]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    cols = ["band", "x", "y", "own", "id", "root", "n", "regs"]
    rows = in_blocks(apart, ["band"], "id").join(classes, "id").select(cols)
    likely = store(dealt(rows, ["band"]).transform(in_arrow, members, "band long, id long, root long").distinct(), "near-likely-members")
    sets = _sets(likely.select("id").distinct(), docs, key, text)
    rows = in_blocks(likely, ["band"], "id").join(classes, "id").join(sets, "id").select(*cols, "s")
    return dealt(rows, ["band"]).transform(in_arrow, links, "a long, b long").distinct()


def _unpack(s: bytes) -> np.ndarray:
    """A set from its 5-byte hashes."""
    out = np.zeros((len(s) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(s, np.uint8).reshape(-1, 5)
    return out.view("<u8")[:, 0]


def _similar(p: np.ndarray, q: np.ndarray, threshold: int) -> bool:
    x = np.sort(np.concatenate((p, q)))
    both = int(np.count_nonzero(x[1:] == x[:-1]))
    return 100 * both >= threshold * (len(p) + len(q) - both)


def _sets(wanted: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(id, s)``: the full sets of the documents ``wanted(id)``, made anew from
    their texts.  Sets travel as 5-byte hashes: two of n have a false match with
    chance n * n / 2^40."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in chunks(batch, "text"):
                out = [np.unique(x >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes() for x in shingle_sets(data, offs)]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(out, pa.binary())], names=["id", "s"])

    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    own = sieve(texts, "id", wanted).transform(in_arrow, sets, "id long, s binary").groupBy("id").agg(F.max_by("s", F.length("s")).alias("s"))
    return store(own.join(wanted, "id"), "shingle-sets")


def _verify(pairs: DataFrame, docs: DataFrame, key: str, text: str, threshold: int) -> DataFrame:
    """The pairs with 100 * intersection >= threshold * union on the full sets."""
    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_similar(_unpack(x.as_py()), _unpack(y.as_py()), threshold) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    own = _sets(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), docs, key, text)
    return (pairs.join(own.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
            .join(own.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b").select("a", "b", "sa", "sb").transform(in_arrow, test, "a long, b long"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = 85) -> DataFrame:
    """``(<key>, n_shingles, component_id, kept)`` for each distinct ``key``.

    Documents are linked if 100 * |A and B| >= threshold * |A or B| for their sets
    of 5-word shingles; ``component_id`` is the smallest key that links reach.
    Null and empty texts have the empty set and link with nothing.  ``key`` must
    be integer; rows with a null key are left out; of rows with one key the
    largest set (then digest) stands for it.  Equal sets form a class first, so
    copies cost one row; ``band_components`` compares the classes.
    """
    per_row = sketch(docs, key, text).where(F.col("id").isNotNull())
    rows = store(per_row.groupBy("id").agg(F.max(F.struct("n", "digest", "regs")).alias("r")).select("id", "r.*"), "sketches")
    member = rows.groupBy("digest", "n").agg(F.min("id").alias("rep")).where("n > 0")
    classes = store(rows.join(member.select(F.col("rep").alias("id")), "id", "left_semi").select("id", "n", "regs"), "classes")

    def check(pairs: DataFrame) -> DataFrame:
        near = store(_estimate(pairs, classes, threshold), "near-likely")
        return _verify(near, docs, key, text, threshold)

    roots = band_components(_bands(classes), check, "near", lambda apart, _: _link_apart(apart, classes, docs, key, text, threshold))
    whole = (rows.join(member, ["digest", "n"], "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
             .select("id", "n", F.coalesce("root", "rep", "id").alias("component_id")))
    return whole.select(F.col("id").cast(docs.schema[key].dataType).alias(key), F.col("n").cast("long").alias("n_shingles"), "component_id",
                        (F.col("id") == F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = 80) -> DataFrame:
    """One document of each component, the one with the smallest key; of rows
    with one key all or none, rows with a null key stay."""
    gone = near_duplicates(docs, key, text, threshold).where("not kept").select(F.col(key).alias(fresh(docs.columns, "gone")))
    return docs.join(gone, docs[key] == gone[gone.columns[0]], "left_anti")


