"""Log upkeep: topic sizes, compaction, retention, producer de-duplication
and the touch-on-update upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline import rules


def topic_sizes(log: DataFrame) -> DataFrame:
    """Messages per topic: end offset (max + 1) per partition, summed."""
    ends = log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))
    return ends.groupBy("topic").agg(F.sum("end_offset").cast("long").alias("total_messages"))


def compact_log(log: DataFrame, as_of: str, min_lag_seconds: int = 3600,
                keys: tuple[str, ...] = ("topic", "partition", "key")) -> DataFrame:
    """Key compaction: records younger than ``min_lag_seconds`` stay as they
    are; of the older ones only the newest per key survives, and a newest
    null value (tombstone) removes the key.  The newest-per-key is a partial
    ``max_by`` aggregate, so a hot key is folded map-side."""
    cut = F.lit(as_of).cast("timestamp") - F.make_dt_interval(secs=F.lit(min_lag_seconds))
    head = log.where(F.col("ts") >= cut)
    tail = log.where(F.col("ts") < cut)
    cols = [c for c in log.columns if c not in keys]
    newest = tail.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col("offset")).alias("_n"))
    kept = newest.select(*keys, *[F.col(f"_n.{c}").alias(c) for c in cols]).where(F.col("value").isNotNull())
    return head.unionByName(kept)


def retain(log: DataFrame, retention: DataFrame, as_of: str, time_col: str = "ts") -> DataFrame:
    """Per-topic retention: keep rows younger than the topic's retention
    (null = forever).  The retention table is a fixed handful of rows,
    broadcast."""
    j = log.join(F.broadcast(retention), "topic", "left")
    limit = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.col("retention_days"))
    return j.where(F.col("retention_days").isNull() | (F.col(time_col) >= limit)).drop("retention_days")


def retention_df(spark: SparkSession) -> DataFrame:
    return rules.retention_df(spark)


def dedup_events(df: DataFrame, keys: list[str], watermark: str | None = None, time_col: str = "ingest_ts"):
    """Producer-retry de-duplication by (source, sequence).  On a stream the
    state is bounded by a watermark (``dropDuplicatesWithinWatermark``)."""
    if df.isStreaming and watermark:
        return df.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(keys)
    return df.dropDuplicates(keys)


def upsert_touch(target: DataFrame, updates: DataFrame, keys: list[str], now: str,
                 ts_col: str = "updated_at") -> DataFrame:
    """Merge ``updates`` into ``target`` by key: matched rows take the new
    values and ``ts_col = now`` (the on-update trigger), unmatched updates are
    inserted as given, untouched target rows are kept."""
    touched = updates.join(target.select(*keys).withColumn("_m", F.lit(True)), keys, "left")
    touched = touched.withColumn(ts_col, F.when(F.col("_m"), F.lit(now).cast("timestamp"))
                                 .otherwise(F.col(ts_col))).drop("_m")
    kept = target.join(updates.select(*keys), keys, "left_anti")
    return kept.unionByName(touched.select(*target.columns))
