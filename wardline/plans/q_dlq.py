"""Dead-letter queries over the validator's rejected rows."""

from __future__ import annotations

from wardline import rules
from wardline.operators import dlq as dq
from wardline.operators import health as hl
from wardline.operators import ingest
from wardline.plans.fixture_sql import FIXTURES, add_fixture, with_fixtures as W
from wardline.plans.registry import register
from wardline.sources import fixtures as fx

AS_OF = fx.AS_OF_EVENTS

add_fixture("dlq", ["rejected"], """
    SELECT rec_offset,
           json_object('PATIENT', PATIENT, 'ENCOUNTER', ENCOUNTER, 'DATE', DATE, 'CODE', CODE,
                       'DESCRIPTION', DESCRIPTION, 'VALUE', VALUE, 'UNITS', UNITS)::varchar AS original_data,
           error_reason, source_system, ingest_ts AS failed_at, 'patient-vitals' AS topic_intended
    FROM rejected""")
add_fixture("components", ["status_events"], """
    SELECT c.component, c.state, coalesce(t.tasks_total, 0) AS tasks_total,
           coalesce(t.tasks_running, 0) AS tasks_running, coalesce(t.tasks_failed, 0) AS tasks_failed,
           c.state = 'RUNNING' AND coalesce(t.tasks_running, 0) = coalesce(t.tasks_total, 0) AS healthy
    FROM (SELECT component, arg_max(state, rec_offset) AS state FROM status_events GROUP BY component) c
    LEFT JOIN (SELECT component, count(*) AS tasks_total, count_if(task_state = 'RUNNING') AS tasks_running,
                      count_if(task_state = 'FAILED') AS tasks_failed
               FROM (SELECT component, task_id, arg_max(state, rec_offset) AS task_state FROM status_events
                     GROUP BY component, task_id) GROUP BY component) t USING (component)""")
add_fixture("src_status", ["observations"], f"""
    SELECT m.source_system, m.label, m.topic, coalesce(h.count, 0) AS count, h.last_seen,
           epoch(TIMESTAMP '{AS_OF}')::bigint - (epoch_us(h.last_seen) // 1000000) AS gap_seconds,
           CASE WHEN h.last_seen IS NULL THEN 'unknown'
                WHEN epoch(TIMESTAMP '{AS_OF}')::bigint - (epoch_us(h.last_seen) // 1000000) > 300 THEN 'stale'
                ELSE 'healthy' END AS status
    FROM (SELECT source_system, count(*) AS count, max(ingest_ts) AS last_seen FROM observations GROUP BY 1) h
    RIGHT JOIN (VALUES ('csv_lab_export', 'CSV Lab Export', 'patient-vitals'),
                       ('jdbc_postgres', 'PostgreSQL EHR', 'patient-conditions'),
                       ('debezium_mysql', 'MySQL Pharmacy', 'patient-medications')) m(source_system, label, topic)
      USING (source_system)""")


def dlq_compute(spark, d):
    _, rejected = ingest.validate_vitals(fx.landed(spark, d, "observations"),
                                         ingest.patients_dim(fx.landed(spark, d, "patients")))
    return ingest.dlq_records(rejected)


def dlq(spark, d):
    """The stored dead-letter log (what the DLQ topic holds), built once by
    ``dlq_records``; the analytics read it like the reference reads the topic."""
    return fx.land(spark, d, "dlq", lambda: dlq_compute(spark, d))


def components(spark, d):
    return hl.component_health(fx.landed(spark, d, "status_events"))


def src_status(spark, d):
    return hl.source_status(spark, hl.source_health(fx.landed(spark, d, "observations")), AS_OF)


_CAT = "CASE WHEN strpos(coalesce(error_reason, 'unknown'), ':') > 0 THEN split_part(error_reason, ':', 1) " \
       "ELSE coalesce(error_reason, 'unknown') END"


@register("dlq_recent", W("""
    SELECT rec_offset, coalesce(error_reason, 'unknown') AS error_reason,
           coalesce(source_system, 'unknown') AS source_system,
           coalesce(strftime(failed_at, '%Y-%m-%dT%H:%M:%S.%f'), '') AS failed_at,
           coalesce(topic_intended, '') AS topic_intended,
           cast(row_number() OVER (ORDER BY rec_offset DESC) as bigint) AS rank
    FROM dlq ORDER BY rec_offset DESC LIMIT 100""", "dlq"))
def q_dlq_recent(spark, d):
    return dq.dlq_recent(dlq(spark, d), 100)


@register("dlq_tail", W("""
    SELECT rec_offset, coalesce(error_reason, 'unknown') AS error_reason,
           coalesce(source_system, 'unknown') AS source_system,
           coalesce(strftime(failed_at, '%Y-%m-%dT%H:%M:%S.%f'), '') AS failed_at,
           coalesce(topic_intended, '') AS topic_intended,
           cast(row_number() OVER (ORDER BY rec_offset DESC) as bigint) AS rank
    FROM dlq ORDER BY rec_offset DESC LIMIT 5""", "dlq"))
def q_dlq_tail(spark, d):
    return dq.dlq_recent(dlq(spark, d), 5)


@register("dlq_by_category", W(f"""
    SELECT category, errors, cast(row_number() OVER (ORDER BY errors DESC, category) as bigint) AS rank
    FROM (SELECT {_CAT} AS category, count(*) AS errors FROM dlq GROUP BY 1)""", "dlq"))
def q_dlq_by_category(spark, d):
    return dq.by_category(dlq(spark, d))


@register("dlq_breakdown", W(f"""
    SELECT 'category' AS dimension, trim({_CAT}) AS value, count(*) AS errors FROM dlq GROUP BY 2
    UNION ALL SELECT 'source_system', coalesce(source_system, 'unknown'), count(*) FROM dlq GROUP BY 2
    UNION ALL SELECT 'topic_intended', coalesce(topic_intended, 'unknown'), count(*) FROM dlq GROUP BY 2
    UNION ALL SELECT 'field', column1, count(*) FROM dlq
              JOIN (VALUES ('MISSING_VALUE', 'VALUE'), ('INVALID_VALUE', 'VALUE'), ('OUT_OF_RANGE', 'VALUE'),
                           ('UNKNOWN_PATIENT', 'PATIENT'), ('MISSING_DATE', 'DATE')) f(column0, column1)
                ON column0 = trim({_CAT}) GROUP BY 2""", "dlq"))
def q_dlq_breakdown(spark, d):
    return dq.breakdown(dq.with_field(dlq(spark, d)))


@register("dlq_top_reasons", W("""
    SELECT coalesce(error_reason, 'unknown') AS reason, count(*) AS errors,
           row_number() OVER (ORDER BY count(*) DESC, coalesce(error_reason, 'unknown')) AS rank
    FROM dlq GROUP BY 1 QUALIFY rank <= 10""", "dlq"))
def q_dlq_top_reasons(spark, d):
    return dq.top_reasons(dlq(spark, d), 10)


@register("dlq_timeline", W("""
    SELECT strftime(failed_at, '%Y-%m-%dT%H') AS hour, count(*) AS errors FROM dlq
    WHERE failed_at IS NOT NULL GROUP BY 1""", "dlq"))
def q_dlq_timeline(spark, d):
    return dq.timeline(dlq(spark, d))


@register("dlq_burst", W("""
    SELECT (SELECT count(*) FROM dlq) AS total_errors, coalesce(max(errors), 0) AS max_hour_errors,
           coalesce(max(errors) > (SELECT count(*) FROM dlq) * 0.5, false) AS is_burst
    FROM (SELECT strftime(failed_at, '%Y-%m-%dT%H') AS hour, count(*) AS errors FROM dlq
          WHERE failed_at IS NOT NULL GROUP BY 1)""", "dlq"))
def q_dlq_burst(spark, d):
    return dq.burst(dlq(spark, d))


@register("dlq_recency", W(f"""
    SELECT CASE WHEN count(*) > 0 THEN 'ERRORS_FOUND' ELSE 'CLEAN' END AS status, count(*) AS total_errors,
           count_if(_age < 300) AS last_5_minutes, count_if(_age >= 300 AND _age < 3600) AS last_1_hour,
           count_if(_age IS NULL OR _age >= 3600) AS older,
           CASE WHEN count_if(_age < 300) > 10 THEN 'CRITICAL' WHEN count_if(_age < 300) > 0 THEN 'WARNING'
                ELSE 'INFO' END AS severity
    FROM (SELECT epoch(TIMESTAMP '{AS_OF}')::bigint - (epoch_us(failed_at) // 1000000) AS _age FROM dlq)""", "dlq"))
def q_dlq_recency(spark, d):
    return dq.recency(dlq(spark, d), AS_OF)


_ROOT = """CASE WHEN lower(reason) LIKE '%out_of_range%' OR lower(reason) LIKE '%range%'
                 THEN 'Data values outside expected boundaries'
            WHEN lower(reason) LIKE '%schema%' OR lower(reason) LIKE '%serialization%' OR lower(reason) LIKE '%avro%'
                 THEN 'Schema mismatch between producer and registry'
            WHEN lower(reason) LIKE '%missing%' OR lower(reason) LIKE '%null%' OR lower(reason) LIKE '%required%'
                 THEN 'Required fields are NULL or missing in source data'
            WHEN lower(reason) LIKE '%connect%' OR lower(reason) LIKE '%timeout%' OR lower(reason) LIKE '%refused%'
                 THEN 'Connector cannot reach the source database'
            ELSE 'Unknown error type — requires manual investigation' END"""


@register("dlq_diagnosis", W(f"""
    SELECT reason AS most_common_error, n AS occurrence_count,
           round(n / (SELECT count(*) FROM dlq) * 100, 1) AS percentage, {_ROOT} AS root_cause
    FROM (SELECT coalesce(error_reason, 'unknown') AS reason, count(*) AS n, min(rec_offset) AS first
          FROM dlq GROUP BY 1)
    ORDER BY n DESC, first LIMIT 1""".replace("LIKE '%out_of_range%'", "LIKE '%out\\_of\\_range%' ESCAPE '\\'"),
                             "dlq"))
def q_dlq_diagnosis(spark, d):
    return dq.diagnosis(dlq(spark, d))


def _advice_rows() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    texts = {name: text for name, _, text in rules.ROOT_CAUSES} | {"unknown": rules.ROOT_CAUSE_UNKNOWN}
    out = []
    for name, (likely, fixes, again) in rules.ROOT_CAUSE_ADVICE.items():
        told = [("likely_reason", 0, likely), *[("fix", i, f) for i, f in enumerate(fixes, 1)], ("reprocess", 0, again)]
        out += [f"({quote(texts[name])}, '{part}', {step}, {quote(text)})" for part, step, text in told if text]
    return ", ".join(out)


@register("dlq_diagnosis_advice", W(f"""
    SELECT reason AS most_common_error, root_cause, part, step, text
    FROM (SELECT reason, {_ROOT} AS root_cause
          FROM (SELECT coalesce(error_reason, 'unknown') AS reason, count(*) AS n, min(rec_offset) AS first
                FROM dlq GROUP BY 1) ORDER BY n DESC, first LIMIT 1)
    JOIN (VALUES {_advice_rows()}) a(root_cause, part, step, text) USING (root_cause)""", "dlq"))
def q_dlq_diagnosis_advice(spark, d):
    return dq.diagnosis_advice(dlq(spark, d))


@register("alert_level", W("""
    SELECT (SELECT count(*) FROM dlq) AS dlq_count, count_if(state <> 'RUNNING') AS failed_connectors,
           CASE WHEN (SELECT count(*) FROM dlq) > 20 OR count_if(state <> 'RUNNING') > 0 THEN 'CRITICAL'
                WHEN (SELECT count(*) FROM dlq) > 0 THEN 'WARNING' ELSE 'OK' END AS level
    FROM components""", "dlq", "components"))
def q_alert_level(spark, d):
    return dq.alert_level(dlq(spark, d), components(spark, d))


@register("dlq_alert_report", W("""
    , acts AS (
      SELECT list_concat(
               CASE WHEN (SELECT count(*) FROM dlq) > 0
                    THEN ['DLQ has ' || (SELECT count(*) FROM dlq) || ' errors. Run diagnose_root_cause for detailed analysis.']
                    ELSE []::varchar[] END,
               coalesce((SELECT list('Connector ''' || component || ''' is ' || state || '. Restart or check logs.'
                                     ORDER BY component) FROM components WHERE state <> 'RUNNING'), []::varchar[]),
               coalesce((SELECT list('Source ''' || source_system || ''' is ' || status || '. Check data flow.'
                                     ORDER BY source_system) FROM src_status WHERE status <> 'healthy'),
                        []::varchar[])) AS a)
    SELECT (SELECT count(*) FROM dlq) AS dlq_errors, (SELECT count(*) FROM components) AS connectors_total,
           (SELECT count_if(state <> 'RUNNING') FROM components) AS connectors_failed,
           (SELECT count_if(status <> 'healthy') FROM src_status) AS sources_alerting,
           CASE WHEN len(a) = 0 THEN 'LOW'
                WHEN (SELECT count_if(state <> 'RUNNING') FROM components) > 0 THEN 'CRITICAL'
                WHEN (SELECT count(*) FROM dlq) > 20 THEN 'HIGH'
                WHEN (SELECT count(*) FROM dlq) > 0 THEN 'MEDIUM' ELSE 'LOW' END AS priority,
           CASE WHEN len(a) = 0 THEN 1 ELSE len(a) END::bigint AS actions_needed,
           to_json(CASE WHEN len(a) = 0 THEN ['All systems operating normally. No action needed.'] ELSE a END)::varchar
             AS recommended_actions
    FROM acts""", "dlq", "components", "src_status"))
def q_dlq_alert_report(spark, d):
    return dq.alert_report(dlq(spark, d), components(spark, d), src_status(spark, d))


def _replay_sql() -> str:
    """The validator SQL re-pointed at the decoded, repaired dead letters."""
    base = {k: v for k, v in FIXTURES.items()}
    c0 = base["_classified0"][1].replace("FROM observations o", "FROM replay_rows o")
    c1 = base["_classified1"][1].replace("FROM _classified0", "FROM r_c0")
    c2 = base["classified"][1].replace("FROM _classified1", "FROM r_c1")
    return f""", replay_rows AS (
        SELECT rec_offset, o.PATIENT, o.ENCOUNTER, o.DATE, o.CODE, o.DESCRIPTION,
               replace(CASE WHEN o.CODE = '8310-5' AND try_cast(replace(trim(o.VALUE), ',', '.') as double)
                                 BETWEEN 25 AND 45
                            THEN format('{{:.2f}}', try_cast(replace(trim(o.VALUE), ',', '.') as double) * 9 / 5 + 32)
                            ELSE replace(trim(o.VALUE), ',', '.') END, ',', '') AS VALUE,
               o.UNITS
        FROM (SELECT rec_offset, json_extract_string(original_data, '$.PATIENT') AS PATIENT,
                     json_extract_string(original_data, '$.ENCOUNTER') AS ENCOUNTER,
                     json_extract_string(original_data, '$.DATE') AS DATE,
                     json_extract_string(original_data, '$.CODE') AS CODE,
                     json_extract_string(original_data, '$.DESCRIPTION') AS DESCRIPTION,
                     json_extract_string(original_data, '$.VALUE') AS VALUE,
                     json_extract_string(original_data, '$.UNITS') AS UNITS FROM dlq) o),
    r_c0 AS ({c0}), r_c1 AS ({c1}), r_c2 AS ({c2})
    SELECT rec_offset, PATIENT, CODE, VALUE, error_reason,
           CASE WHEN is_vital AND error_reason IS NULL THEN 'valid' ELSE 'dlq' END AS route FROM r_c2"""


@register("dlq_replay", W(_replay_sql(), "dlq", "patients"))
def q_dlq_replay(spark, d):
    return dq.replay(dlq(spark, d), ingest.patients_dim(fx.landed(spark, d, "patients")))
