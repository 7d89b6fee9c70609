"""Alert, patient-list and action-queue queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline import rules
from wardline.operators import alerts as al
from wardline.plans.fixture_sql import add_fixture, with_fixtures as W
from wardline.plans.q_context import context, current
from wardline.plans.q_readmit import risk_latest
from wardline.plans.registry import register


def _sql_cond(vital, kind, op, thr):
    if kind == "value":
        cmp = f"value {op} {thr}"
        return f"vital = '{vital}' AND value IS NOT NULL AND value <> 0 AND NOT isnan(value) AND {cmp}"
    return f"vital = '{vital}' AND direction = '{op}' AND NOT isnan(abs(pct_change)) AND abs(pct_change) > {thr}"


def _sql_msg(tmpl):
    out, rest = [], tmpl
    subs = {"{v0}": "printf('%.0f', value)", "{v1}": "printf('%.1f', value)",
            "{p1}": "printf('%.1f', abs(pct_change))", "{v}": "cast(value as varchar)"}
    while rest:
        hits = [(rest.find(k), k) for k in subs if rest.find(k) >= 0]
        if not hits:
            out.append("'" + rest.replace("'", "''") + "'")
            break
        i, k = min(hits)
        if i:
            out.append("'" + rest[:i].replace("'", "''") + "'")
        out.append(subs[k])
        rest = rest[i + len(k):]
    return " || ".join(out)


def _reasons_sql(rule_set):
    parts = [f"SELECT patient_id, vital, {i} AS rule, '{typ}' AS type, {_sql_msg(t)} AS msg FROM current_now "
             f"WHERE {_sql_cond(vn, kind, op, thr)}"
             for i, (vn, kind, op, thr, typ, t) in enumerate(rule_set)]
    return "\nUNION ALL ".join(parts)


add_fixture("reasons", ["current_now"], _reasons_sql(rules.DASHBOARD_ALERT_RULES))
add_fixture("attention", ["current_now"], _reasons_sql(rules.ATTENTION_RULES))
add_fixture("alert_sum", ["reasons"], """
    SELECT patient_id, count(*) AS n_reasons,
           CASE WHEN max(CASE WHEN type = 'critical' THEN 1 ELSE 0 END) = 1 THEN 'critical' ELSE 'warning' END
             AS severity
    FROM reasons GROUP BY patient_id""")


def reasons(spark, d, rule_set=None):
    return al.evaluate_alerts(current(spark, d), rule_set)


@register("alert_reasons", W("SELECT * FROM reasons", "reasons"))
def q_alert_reasons(spark, d):
    return reasons(spark, d)


@register("alerts", W("""
    SELECT a.*, c.patient_age AS age, c.patient_gender AS gender, c.conditions,
           row_number() OVER (ORDER BY n_reasons DESC, severity, patient_id) AS rank
    FROM alert_sum a JOIN context_now c USING (patient_id)""", "alert_sum", "context_now"))
def q_alerts(spark, d):
    s = al.alert_summary(reasons(spark, d))
    c = context(spark, d).select("patient_id", F.col("patient_age").alias("age"),
                                 F.col("patient_gender").alias("gender"), F.to_json("conditions").alias("conditions"))
    return al.ranked_alerts(s.join(c, "patient_id"), c)


@register("attention_reasons", W("SELECT patient_id, vital, rule, msg FROM attention", "attention"))
def q_attention_reasons(spark, d):
    return reasons(spark, d, rules.ATTENTION_RULES).drop("type")


@register("attention_top20", W("""
    SELECT patient_id, n_reasons, cast(row_number() OVER (ORDER BY n_reasons DESC, patient_id) as bigint) AS rank,
           (SELECT count(DISTINCT patient_id) FROM attention) AS total_flagged
    FROM (SELECT patient_id, count(*) AS n_reasons FROM attention GROUP BY patient_id)
    ORDER BY n_reasons DESC, patient_id LIMIT 20""", "attention"))
def q_attention_top20(spark, d):
    return al.attention_top(reasons(spark, d, rules.ATTENTION_RULES), 20)


_PIVOT = ", ".join(
    f"max(value) FILTER (WHERE vital = '{v}') AS {v}_value, max(units) FILTER (WHERE vital = '{v}') AS {v}_units, max(direction) FILTER (WHERE vital = '{v}') AS {v}_trend, "
    f"max(pct_change) FILTER (WHERE vital = '{v}') AS {v}_pct" for v in [x[2] for x in rules.VITALS])


@register("patient_list", W(f"""
    SELECT c.patient_id, c.patient_age AS age, c.patient_gender AS gender, c.conditions, c.medications,
           c.condition_count, c.medication_count, c.last_update AS last_updated, p.* EXCLUDE (patient_id),
           t.risk_level, cast(t.risk_pct as double) AS risk_pct, t.readmit_probability,
           row_number() OVER (ORDER BY c.patient_id) AS rank
    FROM context_now c
    LEFT JOIN (SELECT patient_id, {_PIVOT} FROM current_now GROUP BY patient_id) p ON p.patient_id = c.patient_id
    LEFT JOIN top_stay t ON t.patient_id = c.patient_id""", "context_now", "current_now", "top_stay"))
def q_patient_list(spark, d):
    c = context(spark, d)
    c = c.withColumn("conditions", F.to_json("conditions")).withColumn("medications", F.to_json("medications"))
    return al.patient_list(c, current(spark, d), risk_latest(spark, d))


@register("patient_list_small", W("""
    SELECT patient_id, patient_age AS age, patient_gender AS gender, condition_count AS conditions_count,
           medication_count AS medications_count, vital_count > 0 AS has_vitals,
           cast(row_number() OVER (ORDER BY patient_id) as bigint) AS rank,
           (SELECT count(*) FROM context_now) AS total_patients
    FROM context_now ORDER BY patient_id LIMIT 50""", "context_now"))
def q_patient_list_small(spark, d):
    return al.patient_list_small(context(spark, d), 50)


@register("source_impact", W("""
    , agg AS (SELECT count_if(vital_count > 0) AS csv, count_if(condition_count > 0) AS postgres,
                     count_if(medication_count > 0) AS mysql, count(*) AS total_patients FROM context_now)
    SELECT source, label, topic, data_type, patients_affected, total_patients,
           round(patients_affected / greatest(total_patients, 1) * 100, 1) AS impact_percentage
    FROM (SELECT 'csv' AS source, 'CSV Lab Export' AS label, 'patient-vitals' AS topic,
                 'vital signs' AS data_type, csv AS patients_affected, total_patients FROM agg
          UNION ALL SELECT 'postgres', 'PostgreSQL EHR', 'patient-conditions', 'conditions/diagnoses', postgres,
                 total_patients FROM agg
          UNION ALL SELECT 'mysql', 'MySQL Pharmacy', 'patient-medications', 'medications', mysql,
                 total_patients FROM agg)""", "context_now"))
def q_source_impact(spark, d):
    return al.source_impact(context(spark, d))


@register("action_queue", W("""
    SELECT *, row_number() OVER (ORDER BY score DESC, patient_id) AS rank FROM (
    SELECT patient_id, coalesce(n_reasons, 0) AS n_reasons, coalesce(severity, 'none') AS severity, risk_level,
           cast(risk_pct as double) AS risk_pct,
           round(CASE WHEN coalesce(severity, 'none') = 'critical' THEN 50.0 ELSE 0.0 END
                 + least(coalesce(n_reasons, 0), 5) * 10.0 + coalesce(cast(risk_pct as double), 0.0) * 0.5, 2)
             AS score,
           CASE WHEN coalesce(severity, 'none') = 'critical' AND coalesce(risk_level IN ('HIGH', 'CRITICAL'), false)
                  THEN 'Immediate bedside review and care-team huddle'
                WHEN coalesce(severity, 'none') = 'critical' THEN 'Immediate bedside review'
                WHEN coalesce(severity, 'none') = 'warning' AND coalesce(risk_level IN ('HIGH', 'CRITICAL'), false)
                  THEN 'Review vitals today and schedule transition-of-care follow-up'
                WHEN coalesce(severity, 'none') = 'warning' THEN 'Review vitals today'
                WHEN coalesce(risk_level IN ('HIGH', 'CRITICAL'), false) THEN 'Schedule transition-of-care follow-up'
           END AS action
    FROM alert_sum a FULL OUTER JOIN (SELECT patient_id, risk_level, risk_pct FROM top_stay) t USING (patient_id)
    WHERE coalesce(n_reasons, 0) > 0 OR coalesce(risk_level IN ('HIGH', 'CRITICAL'), false))""",
                             "alert_sum", "top_stay"))
def q_action_queue(spark, d):
    return al.action_queue(al.alert_summary(reasons(spark, d)), risk_latest(spark, d))
