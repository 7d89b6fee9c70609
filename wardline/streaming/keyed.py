"""A keyed table for streaming sinks: merge on read.

``base/`` holds all rows up to a version, ``delta/`` the changed rows of each later
one, both in folders by version and by a hash bucket of the key; ``commits/`` and
``pointer/`` name the versions of them that are whole.  A batch writes its own rows
only, so bytes follow the batch and not the table.  A reader takes the newest
committed base and the committed deltas after it, and the newest row of each key.

A replayed batch overwrites its own version.  What was written without its commit is
not read.  Whether something exists is asked of the file system; every other error of
a read stops the batch, so no version is built upon less than was there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def folders(spark: SparkSession, path: str, start: str) -> list[str]:
    """The names in the folder ``path`` that begin with ``start``; none if there is no
    such folder."""
    if not exists(spark, path):
        return []
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    return [n for n in (f.getPath().getName() for f in found) if n.startswith(start)]


class KeyedTable:
    """Rows by ``keys``; a row whose ``gone`` column is true takes its key out."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 8, gone: str | None = None):
        self.spark, self.path, self.keys, self.buckets, self.gone = spark, path, keys, buckets, gone

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _put(self, df: DataFrame, part: str, version: int) -> None:
        at = f"{self.path}/{part}/v={int(version)}"
        (df.withColumn("bucket", self._bucket()).repartition(self.buckets, "bucket").write
         .mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(at))

    def _mark(self, part: str, version: int) -> None:
        self.spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{part}/v={int(version)}")

    def _versions(self, part: str) -> list[int]:
        """The versions that have been marked whole: names of folders, no rows."""
        top = f"{self.path}/{part}"
        return sorted(int(n[2:]) for n in folders(self.spark, top, "v=") if exists(self.spark, f"{top}/{n}/_SUCCESS"))

    def write(self, df: DataFrame, version: int) -> None:
        """Commit ``df``, one row for each key that changes, as ``version``."""
        self._put(df, "delta", version)
        self._mark("commits", version)

    def _rows(self, before: int | None) -> DataFrame | None:
        """Every stored row that counts, with its version."""
        ok = lambda v: before is None or v < before
        bases = [v for v in self._versions("pointer") if ok(v)]
        base = bases[-1] if bases else None
        deltas = [v for v in self._versions("commits") if ok(v) and (base is None or v > base)]
        # each version is a folder of its own and read with its own columns
        parts = [(f"{self.path}/base/v={base}", base)] if base is not None else []
        parts += [(f"{self.path}/delta/v={v}", v) for v in deltas]
        out: DataFrame | None = None
        for path, v in parts:
            if not folders(self.spark, path, "bucket="):
                continue  # a batch without rows
            own = self.spark.read.option("recursiveFileLookup", "false").parquet(path).withColumn("_v", F.lit(v).cast("long"))
            out = own if out is None else out.unionByName(own, allowMissingColumns=True)
        return out

    def read(self, before: int | None = None, within: DataFrame | None = None) -> DataFrame | None:
        """The newest row of each key (of versions under ``before``); None if no row
        was committed.  ``within`` holds the only keys wanted: their buckets are the
        only folders read."""
        rows = self._rows(before)
        if rows is None:
            return None
        if within is not None:
            wanted = within.select(*self.keys).distinct()
            here = [r[0] for r in wanted.select(self._bucket()).distinct().collect()]  # at most ``buckets`` rows
            rows = rows.where(F.col("bucket").isin(here)).join(wanted, self.keys, "left_semi")
        columns = [c for c in rows.columns if c not in ("_v", "bucket")]
        rest = [c for c in columns if c not in self.keys]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), F.col("_v")).alias("_r"))
        out = newest.select(*self.keys, *[F.col("_r")[c].alias(c) for c in rest]).select(*columns)
        return out if self.gone is None else out.where(~F.coalesce(F.col(self.gone), F.lit(False)))

    def compact(self, version: int) -> None:
        """Commit everything up to ``version`` as the base; keys that are gone leave.
        Older readers keep what they read."""
        rows = self.read(before=version + 1)
        if rows is not None:
            self._put(rows, "base", version)
            self._mark("pointer", version)
