"""Streaming-table queries: per-patient lists, windowed statistics,
throughput, data-quality stream, typed stream declarations, connectors."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.operators import changes, tables
from wardline.plans.fixture_sql import with_fixtures as W
from wardline.plans.q_ingest import enriched
from wardline.plans.registry import register
from wardline.sources import fixtures as fx
from wardline.sources import poll, stream


@register("conditions_latest", W("""
    SELECT c.patient_id, c.rec_offset, c.condition_name, c.severity, a.condition_count, a.last_updated
    FROM conditions c JOIN (SELECT patient_id, count(*) AS condition_count, max(updated_at) AS last_updated
                            FROM conditions GROUP BY patient_id) a USING (patient_id)""", "conditions"))
def q_conditions_latest(spark, d):
    # long form: list position = rec_offset (array form: tables.conditions_latest)
    return tables.conditions_rows(fx.landed(spark, d, "conditions"))


@register("medications_latest", W("""
    SELECT m.patient_id, m.rec_offset, m.medication_name, m.dosage, a.medication_count, a.last_updated
    FROM medications m JOIN (SELECT patient_id, count(*) AS medication_count, max(updated_at) AS last_updated
                             FROM medications GROUP BY patient_id) a USING (patient_id)""", "medications"))
def q_medications_latest(spark, d):
    return tables.medications_rows(fx.landed(spark, d, "medications"))


@register("conditions_per_patient", W("""
    SELECT patient_id, count(*) AS condition_count, max(updated_at) AS last_updated
    FROM conditions GROUP BY patient_id""", "conditions"))
def q_conditions_per_patient(spark, d):
    return tables.per_key(fx.landed(spark, d, "conditions"), "patient_id", "updated_at", "condition_count")


@register("medications_per_patient", W("""
    SELECT patient_id, count(*) AS medication_count, max(updated_at) AS last_updated
    FROM medications GROUP BY patient_id""", "medications"))
def q_medications_per_patient(spark, d):
    return tables.per_key(fx.landed(spark, d, "medications"), "patient_id", "updated_at", "medication_count")


@register("vitals_hourly_stats", W("""
    SELECT patient_id, vital_type, epoch_ms(date_trunc('hour', ingest_ts)) AS window_start,
           epoch_ms(date_trunc('hour', ingest_ts) + INTERVAL 1 hour) AS window_end,
           count(*) AS reading_count, avg(value) AS avg_value, min(value) AS min_value, max(value) AS max_value,
           arg_max(value, rec_offset) FILTER (WHERE value IS NOT NULL) AS latest_value,
           arg_min(value, rec_offset) FILTER (WHERE value IS NOT NULL) AS earliest_value
    FROM enriched GROUP BY ALL""", "enriched"))
def q_vitals_hourly_stats(spark, d):
    return tables.window_stats(enriched(spark, d))


@register("source_throughput", W("""
    SELECT source_system, epoch_ms(date_trunc('minute', ingest_ts)) AS window_start, count(*) AS message_count
    FROM observations GROUP BY ALL""", "observations"))
def q_source_throughput(spark, d):
    return tables.window_count(fx.landed(spark, d, "observations"))


@register("integration_health", W("""
    SELECT source_system, vital_type,
           CASE WHEN value IS NULL THEN 'NULL_VALUE' WHEN value < 0 THEN 'NEGATIVE_VALUE' ELSE 'VALID' END
             AS quality_status,
           value, "timestamp" AS event_time, rec_offset
    FROM enriched""", "enriched"))
def q_integration_health(spark, d):
    return tables.integration_health(enriched(spark, d))


@register("vitals_stream", W("SELECT * EXCLUDE (ingest_ts) FROM enriched", "enriched"))
def q_vitals_stream(spark, d):
    return stream.declare_stream(enriched(spark, d), stream.VITALS_STREAM)


def _declared(schema: T.StructType, table: str, present: set[str]) -> str:
    """A declared stream in SQL: fields that the source lacks are typed nulls; the
    serial number of a row is its arrival."""
    kinds = {"string": "VARCHAR", "int": "INTEGER", "double": "DOUBLE"}
    cols = [f"CAST({'rec_offset' if f.name == 'id' else f.name if f.name in present else 'NULL'} AS {kinds[f.dataType.simpleString()]}) AS {f.name}" for f in schema.fields]
    return f"SELECT {', '.join(cols)}, rec_offset FROM {table}"


@register("conditions_stream", W(_declared(
    stream.CONDITIONS_STREAM, "conditions", {"patient_id", "condition_code", "condition_name", "status", "severity", "updated_at"}), "conditions"))
def q_conditions_stream(spark, d):
    return stream.declare_stream(fx.landed(spark, d, "conditions").withColumn("id", F.col("rec_offset")), stream.CONDITIONS_STREAM)


@register("medications_stream", W(_declared(
    stream.MEDICATIONS_STREAM, "medications", {"patient_id", "medication_name", "dosage", "frequency", "route", "status", "updated_at"}), "medications"))
def q_medications_stream(spark, d):
    return stream.declare_stream(fx.landed(spark, d, "medications").withColumn("id", F.col("rec_offset")), stream.MEDICATIONS_STREAM)


_MED_FIELDS = ["patient_id", "medication_name", "dosage", "frequency", "route", "status"]


@register("cdc_unwrap", W("""
    SELECT rec_offset, patient_id, medication_name, dosage, frequency, route, status, op AS __op,
           epoch_ms(updated_at) AS __source_ts_ms, CASE WHEN op = 'd' THEN 'true' ELSE 'false' END AS __deleted
    FROM medications""", "medications"))
def q_cdc_unwrap(spark, d):
    env = stream.change_envelope(fx.landed(spark, d, "medications"), "op", "updated_at", _MED_FIELDS)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in _MED_FIELDS])
    return stream.cdc_unwrap(env, schema)


@register("incremental_poll", W("""
    SELECT * FROM conditions WHERE updated_at > TIMESTAMP '2000-01-01 00:00:00'""", "conditions"))
def q_incremental_poll(spark, d):
    return stream.incremental_poll(fx.landed(spark, d, "conditions"), "updated_at", "2000-01-01 00:00:00")


@register("poll_page", W("""
    SELECT * FROM conditions WHERE (updated_at, patient_id || ':' || rec_offset) > (TIMESTAMP '1998-01-01 00:00:00', 'P0001:5')
    ORDER BY updated_at, patient_id || ':' || rec_offset LIMIT 1000""", "conditions"))
def q_poll_page(spark, d):
    c = fx.landed(spark, d, "conditions").withColumn("k", F.concat("patient_id", F.lit(":"), "rec_offset"))
    return poll.page(c, "updated_at", "k", ("1998-01-01 00:00:00", "P0001:5"), 1000).drop("k")


@register("change_apply", W("""
    SELECT patient_id, medication_name, dosage, frequency, route, status, op, position
    FROM (SELECT patient_id, medication_name, dosage, frequency, route, status, op, rec_offset AS position,
                 row_number() OVER (PARTITION BY patient_id, medication_name ORDER BY rec_offset DESC) AS r FROM medications)
    WHERE r = 1 AND op <> 'd'""", "medications"))
def q_change_apply(spark, d):
    """The table after a snapshot of the first half of each log and a log that
    overlaps it, out of order, with replays."""
    log = fx.landed(spark, d, "medications").select(*_MED_FIELDS, "op", F.col("rec_offset").alias("position"))
    half = F.pmod(F.xxhash64("patient_id"), F.lit(20)) + 5
    snapshot = changes.merged(log.where(F.col("position") <= half), ["patient_id", "medication_name"])
    late = log.where(F.col("position") > half - 4)
    replayed = late.unionAll(late.where(F.col("position") % 3 == 0))
    return changes.apply_changes(snapshot, replayed, ["patient_id", "medication_name"])


@register("topic_route", W("""
    SELECT rec_offset, 'patient-conditions' AS topic, patient_id AS "key" FROM conditions""", "conditions"))
def q_topic_route(spark, d):
    c = fx.landed(spark, d, "conditions").withColumn("topic", F.lit("patient_conditions"))
    c = stream.value_to_key(stream.topic_route(c, "topic", "patient_conditions", "patient-conditions"), "patient_id")
    return c.select("rec_offset", "topic", "key")
