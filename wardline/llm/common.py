"""Helpers shared by the corpus operators: written intermediates, names that
cannot clash, connected components, and vectorised byte kernels for tasks."""

from __future__ import annotations

import functools
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.session import scratch_path

# ---------------------------------------------------------------- DataFrames


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context, so that
    executors need no installed copy."""
    sc = spark.sparkContext
    if not getattr(sc, "_wardline_shipped", False):
        top = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="wardline-")) / "wardline.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(top.rglob("*.py")):
                z.write(f, f.relative_to(top.parent))
        sc.addPyFile(str(target))
        sc._wardline_shipped = True


def in_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """``df.mapInArrow(fn, schema)`` with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def fresh(columns: list[str], name: str) -> str:
    """``name``, or with underscores behind it until no column has that name."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def store(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: cuts
    lineage and survives the loss of executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the folder behind a DataFrame made by ``store``."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of undirected ``edges(a long, b long)``.

    Returns ``(node, root)``, one row for each node that has an edge to another
    node; ``root`` is the component's smallest node.  Alternates large-star and
    small-star steps (each node's smallest neighbour becomes the centre of its
    larger, then of its smaller neighbours) until the edges stay the same; each
    round is a written table.  Neighbourhoods are only aggregated (min) and
    joined back, never gathered, so a node of any degree is split by AQE.
    """
    def stars(e: DataFrame) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return both.join(low, "u")

    def large(e: DataFrame) -> DataFrame:
        return stars(e).where("v > u").select(F.col("v").alias("b"), F.col("m").alias("a")).where("a < b").distinct()

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        return (down.join(low, "u").select(F.col("v").alias("b"), F.col("m").alias("a"))
                .unionAll(low.select(F.col("u").alias("b"), F.col("m").alias("a"))).where("a < b").distinct())

    def mark(e: DataFrame) -> tuple:
        row = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return row["n"], row["h"]

    now = store(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), name)
    seen = mark(now)
    while seen[0]:
        then, now = now, store(small(large(now)), name)
        discard(then)
        last, seen = seen, mark(now)
        if seen == last:
            break
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionAll(
        now.select("a").distinct().select(F.col("a").alias("node"), F.col("a").alias("root")))


# ------------------------------------------------------------- byte kernels

CHUNK = 1 << 20
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def byte_table(separators: bytes, lower: bool = True) -> np.ndarray:
    """Byte -> normalised byte, 0 for separators (and for byte 0)."""
    t = ASCII_LOWER.copy() if lower else np.arange(256, dtype=np.uint8)
    t[np.frombuffer(separators, np.uint8)] = 0
    return t


#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
ALNUM = byte_table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column (null: empty)."""
    a = pc.fill_null(column.cast(pa.large_string()), "")
    offs = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    data = a.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offs


def chunks(batch: pa.RecordBatch, text: str, size: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of whole rows with about ``size`` bytes of text (one row may hold
    more): the rows, their bytes, their offsets from 0."""
    if not len(batch):
        return
    data, offs = raw(batch.column(batch.schema.get_field_index(text)))
    lo = 0
    while lo < len(batch):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + size, "right")) - 1)
        hi = min(hi, len(batch))
        yield batch.slice(lo, hi - lo), data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def runs(on: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True that do not cross the rows' ``offs``: starts, ends,
    and for each row the number of runs before it (len(offs) values)."""
    n = len(on)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    first = np.zeros(n + 1, bool)
    first[offs] = True
    begin, end = on.copy(), on.copy()
    begin[1:] &= ~on[:-1] | first[1:n]
    end[:-1] &= ~on[1:] | first[1:n]
    s, e = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(s, offs)


_RNG = np.random.default_rng(0x5EED)
_LUT = _RNG.integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_PINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


@functools.lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def cum(x: np.uint64) -> np.ndarray:
        a = np.full(n + 1, x, np.uint64)
        a[0] = 1
        return np.multiply.accumulate(a)
    return cum(_P), cum(_PINV)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def span_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[s:e], from prefix sums of one polynomial."""
    up, down = _powers(1 << max(16, int(len(data)).bit_length()))
    pre = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LUT[data] * up[:len(data)], out=pre[1:])
    return mix((pre[e] - pre[s]) * down[s])


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive word hashes, at every start that has k words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * _P + words[j:j + n]
    return mix(h)


# -------------------------------------------------------- banded candidates

#: Bits of a sieve; as a table of 64-bit words it has at most SIEVE / 64 rows.
SIEVE = 1 << 23


def sieve(rows: DataFrame, column: str, keys: DataFrame, inside: bool = True) -> DataFrame:
    """The rows whose ``column`` may be in ``keys`` (its only column), or those
    that surely are not: a bitmap of fixed size is broadcast, so that most rows
    are told apart before a shuffle."""
    slot = F.pmod(F.xxhash64(F.lit(7), column), F.lit(SIEVE))
    words = (keys.select(F.pmod(F.xxhash64(F.lit(7), keys.columns[0]), F.lit(SIEVE)).alias("slot"))
             .groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")))
    word, bits, at = (fresh(rows.columns, x) for x in ("word", "bits", "slot"))
    words = words.select(F.col("word").alias(word), F.col("bits").alias(bits))
    marked = rows.withColumn(at, slot).withColumn(word, F.shiftright(at, 6)).join(F.broadcast(words), word, "inner" if inside else "left")
    on = F.getbit(F.coalesce(bits, F.lit(0).cast("long")), F.col(at).bitwiseAND(63).cast("int"))
    return marked.where(on == (1 if inside else 0)).select(*rows.columns)


def band_components(bands: DataFrame, check, name: str, rest=None) -> DataFrame:
    """Components of the links that ``check(pairs(a, b))`` confirms among ids that
    share a band: ``(node, root)`` as ``components`` gives them.

    Each band's smallest and largest id are compared with its other ids; then ids
    of a band that are still in different components are compared with one
    another.  So pairs within a component, of which a large group has many, are
    not made, and no link between components is missed.  Bands are only aggregated
    and joined, never gathered.  ``rest(apart(band, id, root), first(a, b))`` may
    confirm the links between components instead; else all pairs are joined and checked.
    ``check`` sees every id that shares a band in its first call.
    """
    shared = store(bands.groupBy("band").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high"), f"{name}-shared")
    # an inner join: a semi join would be moved below the sieve
    held = store(sieve(bands, "band", shared.select("band")).join(shared.select("band"), "band").select("band", "id"), f"{name}-held")
    ends = held.join(shared, "band")
    stars = ends.where("id > low").select(F.col("low").alias("a"), F.col("id").alias("b")).unionAll(
        ends.where("id > low and id < high").select(F.col("id").alias("a"), F.col("high").alias("b")))
    first = store(stars.distinct(), f"{name}-stars")
    links = store(check(first), f"{name}-links")
    found = components(links, f"{name}-first")
    label = held.join(found.withColumnRenamed("node", "id"), "id", "left").select("band", "id", F.coalesce("root", "id").alias("root"))
    split = label.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("band")
    apart = store(label.join(split, "band", "left_semi"), f"{name}-apart")
    if rest is None:
        l, r = apart.alias("l"), apart.alias("r")
        pairs = l.join(r, (F.col("l.band") == F.col("r.band")) & (F.col("l.id") < F.col("r.id")) & (F.col("l.root") != F.col("r.root")))
        pairs = pairs.select(F.col("l.id").alias("a"), F.col("r.id").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
        more = check(store(pairs, f"{name}-rest"))
    else:
        more = rest(apart, first)
    return components(links.unionAll(more), f"{name}-all")


# ------------------------------------------------------- groups in blocks

#: Rows of a block; larger groups are compared in pairs of blocks.
BLOCK = 512


def in_blocks(rows: DataFrame, by: list[str], key: str) -> DataFrame:
    """``rows`` laid out so that a task meets any two rows of a group ``by``:
    columns ``x <= y`` name two blocks of the group and ``own`` the row's.  Groups
    of more than BLOCK rows take several tasks, those of one row are left out.
    Sorted by ``by, x, y`` within tasks."""
    full = rows.groupBy(*by).agg(F.count("*").alias("c")).where("c > 1").select(*by, F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks"))
    member = rows.join(full, by).withColumn("own", F.pmod(F.xxhash64(key), "blocks").cast("int"))
    member = member.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    return member.withColumns({"x": F.least("own", "with"), "y": F.greatest("own", "with")}).drop("with")


def dealt(rows: DataFrame, by: list[str]) -> DataFrame:
    """Groups ``by, x, y`` each in one task, sorted."""
    return rows.repartition(*by, "x", "y").sortWithinPartitions(*by, "x", "y")


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal ``keys``, of batches sorted by them; runs of one
    row are left out."""
    held = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        part = pa.concat_tables([held, part]).combine_chunks() if held is not None else part
        cols = [part.column(k).to_numpy() for k in keys]
        new = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
        bounds = [0, *new.tolist()]
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            if hi - lo > 1:
                yield part.slice(lo, hi - lo)
        held = part.slice(bounds[-1])
    if held is not None and len(held) > 1:
        yield held
