"""Source health, processing counters, component roll-up, read models,
schema registry report."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.operators import health as hl
from wardline.plans.fixture_sql import add_fixture, with_fixtures as W
from wardline.plans.q_context import readings
from wardline.plans.q_dlq import components, dlq, src_status
from wardline.plans.registry import register
from wardline.sources import fixtures as fx

add_fixture("pstats", ["readings", "conditions", "medications", "dlq"], """
    SELECT (SELECT count(*) FROM readings) AS vitals_processed,
           (SELECT count(*) FROM conditions) AS conditions_processed,
           (SELECT count(*) FROM medications) AS medications_processed,
           (SELECT count(*) FROM dlq) AS dlq_processed, cast(0 as bigint) AS errors""")


def pstats(spark, d):
    return hl.processing_stats(readings(spark, d), fx.landed(spark, d, "conditions"), fx.landed(spark, d, "medications"), dlq(spark, d))


@register("source_health", W("""
    SELECT source_system, count(*) AS count, max(ingest_ts) AS last_seen FROM observations GROUP BY 1""",
                             "observations"))
def q_source_health(spark, d):
    return hl.source_health(fx.landed(spark, d, "observations"))


@register("source_status", W("SELECT * FROM src_status", "src_status"))
def q_source_status(spark, d):
    return src_status(spark, d)


@register("processing_stats", W("SELECT * FROM pstats", "pstats"))
def q_processing_stats(spark, d):
    return pstats(spark, d)


@register("source_overview", W("""
    SELECT s.source_system AS "key", s.label, s.topic, s.status,
           coalesce(CASE s.source_system WHEN 'csv_lab_export' THEN p.vitals_processed
                    WHEN 'jdbc_postgres' THEN p.conditions_processed
                    WHEN 'debezium_mysql' THEN p.medications_processed END, s.count, 0) AS messages_processed,
           s.last_seen, s.gap_seconds
    FROM src_status s, pstats p""", "src_status", "pstats"))
def q_source_overview(spark, d):
    return hl.source_overview(src_status(spark, d), pstats(spark, d))


@register("component_health", W("SELECT * FROM components", "components"))
def q_component_health(spark, d):
    return components(spark, d)


@register("system_status", W("""
    SELECT count(*) AS total, count_if(healthy) AS healthy, count_if(NOT healthy) AS unhealthy,
           CASE WHEN count_if(NOT healthy) = 0 THEN 'HEALTHY' ELSE 'DEGRADED' END AS overall_status
    FROM components""", "components"))
def q_system_status(spark, d):
    return hl.overall_status(components(spark, d))


@register("system_health", W("""
    SELECT CASE WHEN count_if(NOT healthy) = 0 THEN 'healthy' ELSE 'degraded' END AS status,
           (SELECT count(*) FROM (SELECT patient_id FROM readings UNION SELECT patient_id FROM conditions
                                  UNION SELECT patient_id FROM medications)) AS patient_count,
           (SELECT vitals_processed FROM pstats) AS vitals_processed,
           (SELECT conditions_processed FROM pstats) AS conditions_processed,
           (SELECT medications_processed FROM pstats) AS medications_processed,
           (SELECT dlq_processed FROM pstats) AS dlq_processed,
           (SELECT count_if(status = 'healthy') FROM src_status) AS sources_healthy,
           (SELECT count_if(status <> 'healthy') FROM src_status) AS sources_alerting
    FROM components""", "components", "pstats", "src_status", "readings", "conditions", "medications"))
def q_system_health(spark, d):
    # read model over the stored counts (one row per patient seen by any
    # source) instead of re-running the vital validation twice
    from wardline.plans.q_context import seen
    c = seen(spark, d)
    total = c.agg(F.count(F.lit(1))).scalar()
    stats = c.agg(F.sum("vital_readings").cast("long").alias("vitals_processed")).select(
        "vitals_processed",
        fx.landed(spark, d, "conditions").agg(F.count(F.lit(1))).scalar().alias("conditions_processed"),
        fx.landed(spark, d, "medications").agg(F.count(F.lit(1))).scalar().alias("medications_processed"),
        dlq(spark, d).agg(F.count(F.lit(1))).scalar().alias("dlq_processed"))
    return hl.system_health(components(spark, d), stats, src_status(spark, d), total)


@register("schema_versions", W("""
    SELECT subject, arg_max(version, (version, id)) AS version, arg_max(id, (version, id)) AS id,
           arg_max(schema_type, (version, id)) AS schema_type,
           (SELECT count(DISTINCT subject) FROM schema_versions) AS total_subjects
    FROM schema_versions GROUP BY subject""", "schema_versions"))
def q_schema_versions(spark, d):
    return hl.schema_versions(fx.landed(spark, d, "schema_versions"))
