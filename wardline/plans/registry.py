"""Query registry: key -> (Spark callable, DuckDB oracle SQL or None).

Every callable takes ``(spark, sf_dir)`` and reads the driver tables through
the fixture projections, so its work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: The tables behind the fixture projections.
CLINICAL = ("customer", "orders", "lineitem", "part", "events")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from wardline.session import configure, partitions_for
            from wardline.sources.tables import stored_bytes
            configure(spark)
            least = int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions_for(stored_bytes(spark, sf_dir, CLINICAL), least)))
            return fn(spark, sf_dir)
        run.__name__ = run.__qualname__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def load_all() -> None:
    # importing the modules fills the registry
    from wardline.plans import (  # noqa: F401
        q_ingest, q_tables, q_context, q_alerts, q_dlq, q_readmit, q_logs, q_health,
    )
