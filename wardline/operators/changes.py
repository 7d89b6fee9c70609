"""A table kept by a change log: snapshot and changes merged by source position.

A change is a row with a position in the source's log, an operation (``c``, ``u``,
``d``) and the row's state.  The newest position of a key wins, whatever the order of
arrival, so replays and stale changes alter nothing.  A deleted key stays as a
tombstone with its position, or an older change that comes later would bring it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.streaming.keyed import KeyedTable


def merged(changes: DataFrame, keys: list[str], position: str = "position", op: str = "op") -> DataFrame:
    """The newest change of each key, tombstones included: one partial aggregate, so a
    key that holds a large share of the log is folded in each task.  Of two rows at one
    position (a replay) either is the same."""
    rest = [c for c in changes.columns if c not in keys]
    newest = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(position)).alias("_n"))
    return newest.select(*keys, *[F.col("_n")[c].alias(c) for c in rest]).select(*changes.columns)


def apply_changes(snapshot: DataFrame, log: DataFrame, keys: list[str], position: str = "position", op: str = "op",
                  tombstones: bool = False) -> DataFrame:
    """``snapshot`` brought up to date by ``log`` (the same columns; a snapshot's rows
    may have a null ``op``).  Deleted rows are left out unless ``tombstones``."""
    now = merged(snapshot.unionByName(log, allowMissingColumns=True), keys, position, op)
    return now if tombstones else now.where(F.coalesce(F.col(op), F.lit("c")) != "d")


def start_changes(log: DataFrame, keys: list[str], path: str, checkpoint: str, position: str = "position", op: str = "op",
                  trigger: dict | None = None):
    """Apply a stream of changes to a keyed table at ``path``.  A micro-batch reads the
    stored rows of its own keys only and writes those that are newer."""
    def batch(df: DataFrame, batch_id: int) -> None:
        table = changes_table(df.sparkSession, path, keys)
        fresh = merged(df, keys, position, op)
        old = table.read(before=batch_id, within=fresh)
        table.write(fresh if old is None else merged(old.unionByName(fresh), keys, position, op), batch_id)

    return (log.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def changes_table(spark, path: str, keys: list[str]) -> KeyedTable:
    return KeyedTable(spark, path, keys)
