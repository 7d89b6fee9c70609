"""Source health, component roll-up and summary read models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline import rules


def sources_df(spark: SparkSession) -> DataFrame:
    """Static source metadata (3 rows)."""
    return spark.createDataFrame(rules.SOURCE_SYSTEMS, "source_system string, label string, topic string, "
                                                       "data_type string")


def source_health(events: DataFrame, source_col: str = "source_system", time_col: str = "ingest_ts") -> DataFrame:
    """Messages and last arrival per source (partial aggregate)."""
    return events.groupBy(source_col).agg(F.count(F.lit(1)).alias("count"), F.max(time_col).alias("last_seen"))


def source_status(spark: SparkSession, health: DataFrame, as_of: str,
                  stale_after_s: int = rules.STALE_AFTER_SECONDS) -> DataFrame:
    """Every known source with its status at ``as_of``: healthy when the
    last message is at most ``stale_after_s`` old, stale beyond, unknown when
    never seen.  The metadata side is a fixed 3-row table (broadcast)."""
    gap = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp("last_seen")
    j = health.join(F.broadcast(sources_df(spark)), "source_system", "right")
    return j.select("source_system", "label", "topic",
                    F.coalesce("count", F.lit(0)).cast("long").alias("count"), "last_seen",
                    gap.cast("long").alias("gap_seconds"),
                    F.when(F.col("last_seen").isNull(), "unknown").when(gap > stale_after_s, "stale")
                    .otherwise("healthy").alias("status"))


def processing_stats(readings: DataFrame, conditions: DataFrame, medications: DataFrame,
                     dlq: DataFrame) -> DataFrame:
    """Processed counters per stream, each a one-row partial aggregate."""
    def n(df: DataFrame):
        return df.agg(F.count(F.lit(1))).scalar()
    return readings.agg(F.count(F.lit(1)).alias("vitals_processed")).select(
        "vitals_processed", n(conditions).alias("conditions_processed"),
        n(medications).alias("medications_processed"), n(dlq).alias("dlq_processed"),
        F.lit(0).cast("long").alias("errors"))


def source_overview(status: DataFrame, stats: DataFrame) -> DataFrame:
    """Source cards: status and messages processed (processed counter, else
    the health count, else 0)."""
    counters = {"csv_lab_export": "vitals_processed", "jdbc_postgres": "conditions_processed",
                "debezium_mysql": "medications_processed"}
    proc = None
    for src, c in counters.items():
        val = stats.select(c).scalar()
        proc = F.when(F.col("source_system") == src, val) if proc is None else proc.when(
            F.col("source_system") == src, val)
    return status.select(F.col("source_system").alias("key"), "label", "topic", "status",
                         F.coalesce(proc, F.col("count"), F.lit(0)).cast("long").alias("messages_processed"),
                         "last_seen", "gap_seconds")


def component_health(status_events: DataFrame) -> DataFrame:
    """Latest state per component and per task (by offset), task counts and
    health (component and all its tasks RUNNING).  Two partial aggregates."""
    tasks = status_events.groupBy("component", "task_id").agg(F.max_by("state", "rec_offset").alias("task_state"))
    comp = status_events.groupBy("component").agg(F.max_by("state", "rec_offset").alias("state"))
    t = tasks.groupBy("component").agg(
        F.count(F.lit(1)).alias("tasks_total"),
        F.count_if(F.col("task_state") == "RUNNING").alias("tasks_running"),
        F.count_if(F.col("task_state") == "FAILED").alias("tasks_failed"))
    j = comp.join(t, "component", "left")
    healthy = (F.col("state") == "RUNNING") & (F.coalesce("tasks_running", F.lit(0))
                                               == F.coalesce("tasks_total", F.lit(0)))
    return j.select("component", "state", F.coalesce("tasks_total", F.lit(0)).alias("tasks_total"),
                    F.coalesce("tasks_running", F.lit(0)).alias("tasks_running"),
                    F.coalesce("tasks_failed", F.lit(0)).alias("tasks_failed"), healthy.alias("healthy"))


def overall_status(components: DataFrame) -> DataFrame:
    return components.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("healthy").alias("healthy"),
        F.count_if(~F.col("healthy")).alias("unhealthy")).withColumn(
        "overall_status", F.when(F.col("unhealthy") == 0, "HEALTHY").otherwise("DEGRADED"))


def system_health(components: DataFrame, stats: DataFrame, status: DataFrame, total_patients) -> DataFrame:
    """Health read model in one row."""
    ov = overall_status(components)
    return ov.select(
        F.when(F.col("unhealthy") == 0, "healthy").otherwise("degraded").alias("status"),
        total_patients.alias("patient_count"),
        *[stats.select(c).scalar().alias(c) for c in
          ("vitals_processed", "conditions_processed", "medications_processed", "dlq_processed")],
        status.agg(F.count_if(F.col("status") == "healthy")).scalar().alias("sources_healthy"),
        status.agg(F.count_if(F.col("status") != "healthy")).scalar().alias("sources_alerting"))


def schema_versions(versions: DataFrame) -> DataFrame:
    """Latest version per subject (higher id on equal versions) and the
    number of subjects."""
    g = versions.groupBy("subject").agg(F.max_by(F.struct("version", "id", "schema_type"),
                                                  F.struct("version", "id")).alias("_v"))
    total = versions.agg(F.count_distinct("subject")).scalar()
    return g.select("subject", "_v.version", "_v.id", "_v.schema_type", total.alias("total_subjects"))
