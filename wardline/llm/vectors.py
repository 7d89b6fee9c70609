"""Near-duplicate embeddings with cross-polytope hashing.

Fast Hadamard rotations with random signs turn a vector; the axis and sign of its
largest coordinate is a hash, several make a bucket.  A vector lies in one bucket
of each table and also probes the buckets it almost fell into.  What shares a
bucket is compared in double precision, block by block.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import components, dealt, groups, in_arrow, in_blocks, store

#: Tables, hashes of a bucket, buckets a vector probes in each table.
TABLES, HASHES, PROBES = 6, 2, 4


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (a power of two wide)."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), 2)
        h *= 2
    return x.reshape(n, d)


@functools.cache
def _signs(d: int, table: int, which: int) -> np.ndarray:
    return np.random.default_rng([d, table, which]).choice([-1.0, 1.0], (3, d))


def buckets(x: np.ndarray, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES) -> np.ndarray:
    """(rows, tables, probes) buckets of unit vectors, the vector's own first,
    then those that the least change of its coordinates would lead to."""
    n, dim = x.shape
    d = 1 << max(3, (dim - 1).bit_length())
    wide = np.zeros((n, d))
    wide[:, :dim] = x
    top = 4
    out = np.zeros((n, tables, probes), np.int64)
    for t in range(tables):
        code, penalty = np.zeros((n, 1), np.int64), np.zeros((n, 1))
        for j in range(hashes):
            y = wide
            for s in _signs(d, t, j):
                y = hadamard(y * s) / np.sqrt(d)
            order = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :top]
            v = np.take_along_axis(y, order, 1)
            own = 2 * order + (v < 0)
            lack = (np.abs(v[:, :1]) - np.abs(v)) ** 2
            code = (code[:, :, None] * (2 * d) + own[:, None, :]).reshape(n, -1)
            penalty = (penalty[:, :, None] + lack[:, None, :]).reshape(n, -1)
            best = np.argsort(penalty, axis=1, kind="stable")[:, :max(probes, top)]
            code, penalty = np.take_along_axis(code, best, 1), np.take_along_axis(penalty, best, 1)
        out[:, t] = code[:, :probes]
    return out


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1).astype(np.float64)
    return x / np.sqrt((x * x).sum(1))[:, None]


def local_roots(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest member of each member's component under the links (i, j)."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def near_vectors(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", least: float = 0.95,
                 tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES) -> DataFrame:
    """``(<key>, n_links, component_id, kept)``, one row for each input row.

    Vectors of one length with cosine >= ``least`` (double precision) are linked
    if some table has a bucket that both lie in or probe;
    ``n_links`` counts linked vectors, ``component_id`` is the smallest key that
    links reach.  Null and zero vectors, those with null or non-finite components
    and rows with a null key link with nothing.  Equal vectors, repeated rows
    included, are one class with a weight.  A pair that meets in several buckets
    counts in the first.  Buckets with more than BLOCK rows are compared in pairs
    of blocks, so no bucket is gathered; tasks return counts and one link from
    each vector to its block's root, never pairs.
    """
    kind = "<f4" if vectors.schema[embedding].dataType.elementType.typeName() == "float" else "<f8"
    e = F.col(embedding)
    good = (F.size(e) > 0) & F.col(key).isNotNull() & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))) & F.exists(e, lambda x: x != 0)
    if kind == "<f8":
        e = F.transform(e, lambda x: x.cast("double"))
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.when(F.coalesce(good, F.lit(False)), e).alias("e"))
    classes = rows.where("e is not null").groupBy("e").agg(F.min("id").alias("id"), F.count("*").alias("weight"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column(0).offsets.to_numpy())
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            start = np.concatenate(([0], np.cumsum(sizes)))
            for dim in np.unique(sizes):
                own = np.flatnonzero(sizes == dim)
                for at in np.array_split(own, -(-len(own) // 2000)):
                    x = flat[start[at][:, None] + np.arange(dim)].astype(kind)
                    d = x.astype(np.float64)
                    d /= np.abs(d).max(1)[:, None]
                    d /= np.sqrt((d * d).sum(1))[:, None]
                    places = buckets(d, tables, hashes, probes)
                    take = pa.array(at)
                    yield pa.RecordBatch.from_arrays([
                        batch.column(1).take(take), batch.column(2).take(take), pa.array(np.full(len(at), dim, np.int32)), pa.array([r.tobytes() for r in d.astype("<f8")], pa.binary()),
                        pa.array(list(places.reshape(len(at), -1)), pa.list_(pa.int64()))], names=["id", "weight", "dim", "v", "places"])

    base = store(classes.select("e", "id", "weight").transform(in_arrow, hashed, "id long, weight long, dim int, v binary, places array<long>"), "vectors")
    entry = (base.select("id", "dim", F.posexplode("places").alias("at", "bucket"))
             .select("id", "dim", (F.col("bucket") * tables + F.floor(F.col("at") / probes)).alias("place")))
    place = ["dim", "place"]
    data = (in_blocks(entry, place, "id").select("place", "x", "y", "own", "id").join(base, "id")
            .select("dim", "place", "x", "y", "own", "id", "weight", "v", "places"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, ["dim", "place", "x", "y"]):
            x, y = t.column("x")[0].as_py(), t.column("y")[0].as_py()
            own, ids, weight = (t.column(c).to_numpy() for c in ("own", "id", "weight"))
            v = _matrix(t.column("v").combine_chunks(), "<f8")
            i, j = (np.triu(v @ v.T >= least, 1) if x == y else (v @ v.T >= least) & (own[:, None] == x) & (own[None, :] == y)).nonzero()
            if not len(i):
                continue
            places = np.asarray(t.column("places").combine_chunks().flatten()).reshape(len(t), tables, probes)
            here = _first(places, i, j, t.column("place")[0].as_py())
            i, j = i[here], j[here]
            if not len(i):
                continue
            links = np.bincount(i, weight[j], len(t)) + np.bincount(j, weight[i], len(t))
            by = np.argsort(ids, kind="stable")
            rank = np.empty(len(t), np.int64)
            rank[by] = np.arange(len(t))
            root = ids[by][local_roots(rank[i], rank[j], len(t))[rank]]
            on = links > 0
            yield pa.RecordBatch.from_arrays([pa.array(ids[on]), pa.array(links[on].astype(np.int64)), pa.array(root[on])], names=["id", "links", "root"])

    found = store(dealt(data, place).transform(in_arrow, compare, "id long, links long, root long"), "vector-links")
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), "vector-components")
    of_class = (base.select("id", "weight").join(found.groupBy("id").agg(F.sum("links").alias("links")), "id", "left")
                .join(roots.withColumnRenamed("node", "id"), "id", "left")
                .select("id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id")))
    class_of = classes.select("e", F.col("id").alias("class"))
    return (rows.join(class_of, "e", "left").join(of_class.withColumnRenamed("id", "class"), "class", "left")
            .select(F.col("id").cast(vectors.schema[key].dataType).alias(key), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                    F.coalesce("component_id", "id").alias("component_id"), (F.col("id") == F.coalesce("component_id", "id")).alias("kept")))


def _first(places: np.ndarray, i: np.ndarray, j: np.ndarray, place: int) -> np.ndarray:
    """Which pairs meet in this bucket before any other: tables in order, within
    one the smallest bucket that both are in."""
    out = np.zeros(len(i), bool)
    tables, none = places.shape[1], np.iinfo(np.int64).max
    for lo in range(0, len(i), 20_000):
        a, b = places[i[lo:lo + 20_000]], places[j[lo:lo + 20_000]]
        least = np.where((a[:, :, :, None] == b[:, :, None, :]).any(3), a, none).min(2)
        table = (least < none).argmax(1)
        out[lo:lo + 20_000] = least[np.arange(len(table)), table] * tables + table == place
    return out
