"""Fixed values that must equal the reference pipeline's for equal results.

Each table is kept as plain text in natural order and turned into a small
DataFrame (a few rows, a proven size bound) when a plan needs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: vital-sign LOINC codes, display names, context keys and
# physically valid ranges (inclusive) -------------------------------------
VITALS = [
    # code,    description,                 context key,         lo,  hi
    ("8867-4", "Heart Rate",               "heart_rate",        20,  250),
    ("8480-6", "Systolic Blood Pressure",  "systolic_bp",       50,  300),
    ("8462-4", "Diastolic Blood Pressure", "diastolic_bp",      20,  200),
    ("2708-6", "Oxygen Saturation",        "oxygen_saturation", 50,  100),
    ("9279-1", "Respiratory Rate",         "respiratory_rate",  4,   60),
    ("8310-5", "Body Temperature",         "temperature",       90,  110),
]
VITAL_CODES = [v[0] for v in VITALS]
VITAL_KEY = {v[0]: v[2] for v in VITALS}
VALID_RANGE = {v[0]: (v[3], v[4]) for v in VITALS}

# --- fixed values: streaming anomaly rules (first match wins, strict) -----
ANOMALY_RULES = [
    # code,    op,  threshold, anomaly type
    ("8867-4", ">", 120.0, "TACHYCARDIA"),
    ("8867-4", "<", 50.0, "BRADYCARDIA"),
    ("8480-6", ">", 180.0, "HYPERTENSIVE_CRISIS"),
    ("8480-6", "<", 90.0, "HYPOTENSION"),
    ("2708-6", "<", 92.0, "HYPOXEMIA"),
    ("9279-1", ">", 25.0, "TACHYPNEA"),
    ("8310-5", ">", 100.4, "FEVER"),
]

# --- fixed values: dashboard alert rules (all matching rules fire) --------
# kind "value": the current value (non-zero) compared with the threshold;
# kind "trend": direction equal to ``op`` and |pct_change| > threshold.
# Message templates: {v0} value with 0 decimals, {v1} one decimal, {p1}
# |pct| with one decimal, {v} the plain value text.
DASHBOARD_ALERT_RULES = [
    # vital,              kind,    op,        threshold, type,       message
    ("heart_rate",        "value", ">",       100.0, "critical", "Elevated heart rate: {v0} bpm"),
    ("heart_rate",        "trend", "rising",  10.0,  "warning",  "Heart rate rising {p1}%"),
    ("oxygen_saturation", "value", "<",       94.0,  "critical", "Low oxygen saturation: {v1}%"),
    ("oxygen_saturation", "trend", "falling", 3.0,   "warning",  "Oxygen falling {p1}%"),
    ("systolic_bp",       "value", ">",       160.0, "warning",  "High systolic BP: {v0} mmHg"),
    ("systolic_bp",       "value", "<",       90.0,  "warning",  "Low systolic BP: {v0} mmHg"),
    ("temperature",       "value", ">",       100.4, "critical", "Fever: {v1}°F"),
    ("respiratory_rate",  "value", ">",       25.0,  "warning",  "High respiratory rate: {v0}/min"),
]

# --- fixed values: assistant "needs attention" rules (no type) -----------
ATTENTION_RULES = [
    ("heart_rate",        "value", ">",       100.0, "warning", "Elevated heart rate: {v}"),
    ("heart_rate",        "trend", "rising",  10.0,  "warning", "Heart rate rising {p1}%"),
    ("oxygen_saturation", "value", "<",       94.0,  "warning", "Low oxygen: {v}%"),
    ("oxygen_saturation", "trend", "falling", 3.0,   "warning", "Oxygen falling {p1}%"),
    ("systolic_bp",       "value", ">",       160.0, "warning", "High systolic BP: {v}"),
    ("temperature",       "value", ">",       100.4, "warning", "Fever: {v}°F"),
]

# --- fixed values: validation reason texts --------------------------------
REASON_MISSING_VALUE = "MISSING_VALUE: VALUE field is empty"
REASON_INVALID_VALUE = "INVALID_VALUE: Cannot parse '{value}' as number"
REASON_OUT_OF_RANGE = "OUT_OF_RANGE: {code} value {value} outside valid range [{lo}, {hi}]"
REASON_UNKNOWN_PATIENT = "UNKNOWN_PATIENT: Patient {id8}... not in patients.csv"
REASON_MISSING_DATE = "MISSING_DATE: DATE field is empty"

# --- the field of a row that a validation reason is about (by its category) -
REASON_FIELD = {
    "MISSING_VALUE": "VALUE",
    "INVALID_VALUE": "VALUE",
    "OUT_OF_RANGE": "VALUE",
    "UNKNOWN_PATIENT": "PATIENT",
    "MISSING_DATE": "DATE",
}

# --- fixed values: sources, topics and retention (days; None = forever) ---
SOURCE_SYSTEMS = [
    # source key,      label,                 topic,                 data type
    ("csv_lab_export", "CSV Lab Export",      "patient-vitals",      "vital signs"),
    ("jdbc_postgres",  "PostgreSQL EHR",      "patient-conditions",  "conditions/diagnoses"),
    ("debezium_mysql", "MySQL Pharmacy",      "patient-medications", "medications"),
]
RETENTION_DAYS = [
    ("patient-vitals", 30),
    ("patient-conditions", 90),
    ("patient-medications", 90),
    ("integration-health", 7),
    ("risk-alerts", 90),
    ("dead-letter-queue", None),
]
VITALS_TOPIC = "patient-vitals"
DLQ_TOPIC = "dead-letter-queue"
PRODUCER_SOURCE = "csv_lab_export"
RISK_SOURCE = "snowflake_cortex_readmission_model"
RISK_TOPIC = "patient-risk-scores"

# --- fixed values: DLQ root-cause keyword classes (ordered) ---------------
ROOT_CAUSES = [
    ("range", ["out_of_range", "range"], "Data values outside expected boundaries"),
    ("schema", ["schema", "serialization", "avro"], "Schema mismatch between producer and registry"),
    ("missing", ["missing", "null", "required"], "Required fields are NULL or missing in source data"),
    ("connection", ["connect", "timeout", "refused"], "Connector cannot reach the source database"),
]
# likely reason, steps to fix (numbered in this order) and how to reprocess
ROOT_CAUSE_ADVICE = {
    "range": (
        "Source system changed units (e.g., heart rate in bpm vs per-minute) or a sensor is malfunctioning and sending extreme values.",
        ["Check the source system for recent changes to data format or units",
         "Update the Avro schema if the valid range has changed",
         "Add range validation in the producer before sending to Kafka",
         "If sensor issue: flag the device for maintenance"],
        "After fixing, the DLQ messages can be replayed to the main topic: consume from DLQ, fix the values, produce to the original topic."),
    "schema": (
        "A producer is sending data with a schema that doesn't match what's registered. This can happen after a database migration or code deployment.",
        ["Check Schema Registry for the latest schema version",
         "Compare with what the producer is sending",
         "If schema needs to evolve: register new compatible version",
         "If producer bug: fix the producer code and redeploy"],
        "Schema-level failures mean ALL records are likely failing. Fix the schema first, then restart the connector/producer. "
        "Kafka retains the source data, so no data is lost."),
    "missing": (
        "Source system has records with missing required fields. Could be a data entry issue or a source system bug.",
        ["Query the source database for records with NULL required fields",
         "Report to the source system team for data cleanup",
         "Add default values or make fields optional in the schema",
         "Add producer-level validation to catch these before Kafka"],
        "After source data is fixed, reprocess: consume from DLQ, re-validate, and produce to the main topic."),
    "connection": (
        "Database is down, network issue, or credentials expired.",
        ["Check if the source database is reachable: ping hostname",
         "Verify credentials are still valid",
         "Check network/firewall rules",
         "Restart the connector after fixing the connection"],
        "Connection errors mean no data was consumed. Once connection is restored, the connector resumes from its last offset — no data loss."),
    "unknown": (
        None,
        ["Check connector logs: docker logs kafka-connect --tail 100",
         "Check producer logs for error details",
         "Inspect the raw DLQ messages for patterns"],
        None),
}
ROOT_CAUSE_UNKNOWN = "Unknown error type — requires manual investigation"

# --- fixed values: time constants -----------------------------------------
CONTEXT_TTL_SECONDS = 86400
STALE_AFTER_SECONDS = 300
HISTORY_LEN = 10
DLQ_RING = 100


def retention_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RETENTION_DAYS, "topic string, retention_days int")
