"""Keyset polling of a table: pages in the order of ``(time, key)`` after a stored
cursor.

A poll by time alone loses rows that share the mark's time, or reads them twice.  Here
the cursor is the last row's time and key, so a page may end between ties.  The page
and the cursor behind it are committed together under the page's number; a page that
is read again after a failure starts at the same cursor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.streaming.keyed import KeyedTable


def after(table: DataFrame, time_col: str, key: str, cursor: tuple | None) -> DataFrame:
    """The rows behind the cursor ``(time, key)``.  The plain comparison of the time
    reaches the scan or the database; rows without a time are never polled."""
    rows = table.where(F.col(time_col).isNotNull())
    if cursor is None:
        return rows
    t, k = F.lit(cursor[0]).cast("timestamp"), F.lit(cursor[1])
    return rows.where((F.col(time_col) >= t) & ((F.col(time_col) > t) | (F.col(key) > k)))


def page(table: DataFrame, time_col: str, key: str, cursor: tuple | None, size: int) -> DataFrame:
    """The next ``size`` rows: a top-n of each task and one merge of n rows."""
    return after(table, time_col, key, cursor).orderBy(time_col, key).limit(size)


class Poller:
    """Pages of ``read()`` into a keyed table, with the cursor stored beside it."""

    def __init__(self, spark: SparkSession, path: str, read, time_col: str, key: str, size: int = 1000):
        self.spark, self.read, self.time_col, self.key, self.size = spark, read, time_col, key, size
        self.rows = KeyedTable(spark, f"{path}/rows", [key])
        self.cursors = KeyedTable(spark, f"{path}/cursor", ["one"], buckets=1)

    def cursor(self) -> tuple[tuple | None, int]:
        """Time and key of the last polled row, and the number of the next page."""
        stored = self.cursors.read()
        row = stored.first() if stored is not None else None
        return ((row["t"], row["k"]), row["page"] + 1) if row else (None, 0)

    def poll(self) -> int:
        """Read the next page; returns its number of rows, 0 at the end.  The cursor is
        committed last: a page whose cursor is missing is polled again."""
        cursor, number = self.cursor()
        got = page(self.read(), self.time_col, self.key, cursor, self.size).persist()
        try:
            n = got.count()
            if n:
                self.rows.write(got, number)
                last = got.agg(F.max(F.struct(F.col(self.time_col).alias("t"), F.col(self.key).alias("k"))).alias("c")).select("c.*")
                self.cursors.write(last.withColumns({"one": F.lit(1), "page": F.lit(number).cast("long")}), number)
            return n
        finally:
            got.unpersist()
