"""Ingestion queries: scans, validation, dead letters, enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline import rules
from wardline.operators import ingest, tables
from wardline.plans.fixture_sql import with_fixtures as W
from wardline.plans.registry import register
from wardline.sources import fixtures as fx

_VITAL_IN = "('8867-4','8480-6','8462-4','2708-6','9279-1','8310-5')"


def enriched(spark, d):
    return ingest.process_vitals(fx.landed(spark, d, "observations"), fx.landed(spark, d, "patients"))


def classified(spark, d):
    return ingest.classify_observations(fx.landed(spark, d, "observations"), ingest.patients_dim(fx.landed(spark, d, "patients")))


@register("patients_dim", W("SELECT Id, BIRTHDATE, GENDER, MARITAL FROM patients", "patients"))
def q_patients_dim(spark, d):
    return ingest.patients_dim(fx.landed(spark, d, "patients"))


@register("observations_scan", W("SELECT * FROM observations", "observations"))
def q_observations_scan(spark, d):
    return fx.landed(spark, d, "observations")


@register("vitals_only", W(f"SELECT rec_offset, PATIENT, CODE, VALUE FROM observations WHERE CODE IN {_VITAL_IN}",
                           "observations"))
def q_vitals_only(spark, d):
    return ingest.vitals_only(fx.landed(spark, d, "observations")).select("rec_offset", "PATIENT", "CODE", "VALUE")


@register("validate_vitals", W("""
    SELECT rec_offset, PATIENT, CODE, VALUE, error_reason,
           CASE WHEN error_reason IS NULL THEN 'valid' ELSE 'dlq' END AS route
    FROM classified WHERE is_vital""", "classified"))
def q_validate_vitals(spark, d):
    c = classified(spark, d).where("is_vital")
    return c.select("rec_offset", "PATIENT", "CODE", "VALUE", "error_reason",
                    F.when(F.col("error_reason").isNull(), "valid").otherwise("dlq").alias("route"))


@register("enriched_vitals", W("SELECT * EXCLUDE (ingest_ts) FROM enriched", "enriched"))
def q_enriched_vitals(spark, d):
    return enriched(spark, d).drop("ingest_ts")


@register("unknown_patients", W(f"""
    SELECT rec_offset, PATIENT, CODE FROM observations o
    WHERE CODE IN {_VITAL_IN} AND NOT EXISTS (SELECT 1 FROM patients p WHERE p.Id = o.PATIENT)""",
                                "observations", "patients"))
def q_unknown_patients(spark, d):
    return ingest.unknown_patients(fx.landed(spark, d, "observations"), fx.landed(spark, d, "patients")) \
        .select("rec_offset", "PATIENT", "CODE")


@register("dlq_records", W("""
    SELECT rec_offset,
           json_object('PATIENT', PATIENT, 'ENCOUNTER', ENCOUNTER, 'DATE', DATE, 'CODE', CODE,
                       'DESCRIPTION', DESCRIPTION, 'VALUE', VALUE, 'UNITS', UNITS)::varchar AS original_data,
           error_reason, source_system, ingest_ts AS failed_at, 'patient-vitals' AS topic_intended
    FROM rejected""", "rejected"))
def q_dlq_records(spark, d):
    _, rejected = ingest.validate_vitals(fx.landed(spark, d, "observations"), ingest.patients_dim(fx.landed(spark, d, "patients")))
    return ingest.dlq_records(rejected)


def _anomaly_rules() -> str:
    """The rules as a relation: number, code, bounds (one of them null), name."""
    return ", ".join(f"({i}, '{code}', {t if op == '>' else 'NULL'}, {t if op == '<' else 'NULL'}, '{name}')"
                     for i, (code, op, t, name) in enumerate(rules.ANOMALY_RULES))


@register("vital_anomalies", W(f"""
    SELECT patient_id, patient_age, patient_gender, vital_type, vital_description, value, units,
           "timestamp" AS event_time, arg_min(r.name, r.no) AS anomaly_type, 'csv_lab_export' AS source_system, rec_offset
    FROM enriched e JOIN (VALUES {_anomaly_rules()}) r(no, code, above, below, name)
      ON r.code = e.vital_type AND NOT isnan(e.value)
         AND (e.value > cast(r.above AS double) OR e.value < cast(r.below AS double))
    GROUP BY ALL""", "enriched"))
def q_vital_anomalies(spark, d):
    return tables.vital_anomalies(enriched(spark, d))


@register("first_n_vitals", W("""
    SELECT * EXCLUDE (ingest_ts), cast(row_number() OVER (ORDER BY rec_offset) as bigint) AS rank
    FROM enriched ORDER BY rec_offset LIMIT 1000""", "enriched"))
def q_first_n_vitals(spark, d):
    return ingest.first_n(enriched(spark, d).drop("ingest_ts"), 1000)


@register("ingest_stats", W("""
    SELECT count(*) AS total, count_if(is_vital) AS vitals,
           count_if(is_vital AND error_reason IS NULL) AS produced, count_if(NOT is_vital) AS skipped_non_vital,
           count_if(error_reason IS NOT NULL) AS sent_to_dlq, cast(0 as bigint) AS errors
    FROM classified""", "classified"))
def q_ingest_stats(spark, d):
    return ingest.ingest_stats(classified(spark, d))


@register("ingest_keyed", W("""
    SELECT rec_offset, coalesce(PATIENT, 'unknown') AS "key",
           CASE WHEN coalesce(PATIENT, 'unknown') IN ('', 'unknown') THEN 'dlq' ELSE 'topic' END AS route
    FROM observations""", "observations"))
def q_ingest_keyed(spark, d):
    return ingest.ingest_keyed(fx.landed(spark, d, "observations"), "PATIENT").select("rec_offset", "key", "route")
