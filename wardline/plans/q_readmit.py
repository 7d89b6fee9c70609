"""Readmission mart queries and the risk-score loop."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline import rules
from wardline.operators import model
from wardline.operators import readmit as rm
from wardline.plans.fixture_sql import add_fixture, with_fixtures as W
from wardline.plans.registry import register
from wardline.sources import fixtures as fx
from wardline.sources import stream

AS_OF = fx.AS_OF_ORDERS


def age_sql(b: str, r: str) -> str:
    return (f"cast(CASE WHEN {b} IS NULL OR {r} IS NULL THEN -1 ELSE greatest(0, least(120, year({r}) - year({b})"
            f" - CASE WHEN month({r}) < month({b}) OR (month({r}) = month({b}) AND day({r}) < day({b}))"
            f" THEN 1 ELSE 0 END)) END as integer)")


add_fixture("readm", ["stays"], """
    SELECT *, CASE WHEN days_to_next_admit BETWEEN 0 AND 30 THEN 1 ELSE 0 END AS readmitted_30d
    FROM (SELECT *,
            cast(date_diff('day', cast(discharge_time as date), cast(lead(admit_time) OVER w as date)) as integer)
              AS days_to_next_admit,
            cast(row_number() OVER w - 1 as integer) AS prior_admission_count,
            cast(date_diff('day', cast(admit_time as date), cast(discharge_time as date)) as integer)
              AS length_of_stay_days
          FROM stays WINDOW w AS (PARTITION BY patient_id ORDER BY admit_time, encounter_id))""")
add_fixture("asof_counts", ["readm", "conditions", "medications"], """
    SELECT r.encounter_id,
           (SELECT count(*) FROM (SELECT patient_id, condition_name, min(updated_at) AS t FROM conditions
                                  GROUP BY ALL) c WHERE c.patient_id = r.patient_id AND c.t <= r.admit_time)
             AS condition_count,
           (SELECT count(*) FROM (SELECT patient_id, medication_name, min(updated_at) AS t FROM medications
                                  GROUP BY ALL) m WHERE m.patient_id = r.patient_id AND m.t <= r.admit_time)
             AS medication_count
    FROM readm r""")
add_fixture("risk", ["readm", "patients", "asof_counts"], f"""
    SELECT encounter_id, patient_id, age_at_admit, prior_admission_count, condition_count, medication_count,
           length_of_stay_days, readmitted_30d, total_claim_cost, risk_pct,
           cast(risk_pct as double) / 100 AS readmit_probability,
           CASE WHEN risk_pct >= 75 THEN 'CRITICAL' WHEN risk_pct >= 50 THEN 'HIGH' WHEN risk_pct >= 25
                THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
           readmitted_30d AS actual_label
    FROM (SELECT *, cast(least(99, 2 + 4 * prior_admission_count + condition_count + age_at_admit % 40) as integer)
                      AS risk_pct
          FROM (SELECT r.*, {age_sql('_b', 'cast(r.admit_time as date)')} AS age_at_admit,
                       a.condition_count, a.medication_count
                FROM readm r
                JOIN (SELECT Id, cast(try_strptime(BIRTHDATE, '%Y-%m-%d') as date) AS _b FROM patients) p
                  ON p.Id = r.patient_id
                JOIN asof_counts a ON a.encounter_id = r.encounter_id))""")
add_fixture("top_stay", ["risk"], """
    SELECT * EXCLUDE (_r) FROM (SELECT *, row_number() OVER (PARTITION BY patient_id
                                ORDER BY readmit_probability DESC, encounter_id) AS _r FROM risk) WHERE _r = 1""")
add_fixture("risk_msgs", ["top_stay"], f"""
    SELECT patient_id AS "key",
           json_object('patient_id', patient_id, 'risk_level', risk_level, 'risk_pct', cast(risk_pct as double),
                       'readmit_probability', readmit_probability, 'source', '{rules.RISK_SOURCE}')::varchar
             AS "value",
           encounter_id AS rec_offset
    FROM top_stay""")


def readm_compute(spark, d):
    return rm.readmissions(fx.landed(spark, d, "stays"))


def risk_compute(spark, d):
    return rm.risk_fixture(spark, d)


def readm(spark, d):
    """The readmissions mart table (built by ``readmissions``, stored once)."""
    return fx.land(spark, d, "readmissions", lambda: readm_compute(spark, d))


def risk(spark, d):
    """The scored-stays table (model output stand-in), stored once."""
    return fx.land(spark, d, "risk", lambda: risk_compute(spark, d))


def risk_latest(spark, d):
    msgs = rm.risk_messages(rm.top_risk_stay(risk(spark, d)))
    return rm.risk_store(stream.decode_json(msgs, stream.RISK_MESSAGE), AS_OF)


@register("readmissions", W("""
    SELECT * REPLACE (cast(days_to_next_admit as double) AS days_to_next_admit) FROM readm""", "readm"))
def q_readmissions(spark, d):
    # the nullable day gap is compared as double (null for a last stay)
    return readm_compute(spark, d).withColumn("days_to_next_admit", F.col("days_to_next_admit").cast("double"))


@register("training_features", W(f"""
    SELECT r.encounter_id, r.patient_id, {age_sql('p._b', 'cast(r.admit_time as date)')} AS age_at_admit,
           p.GENDER AS gender, p.MARITAL AS marital, r.length_of_stay_days, r.prior_admission_count,
           a.condition_count, a.medication_count, r.total_claim_cost, r.readmitted_30d
    FROM readm r
    LEFT JOIN (SELECT Id, GENDER, MARITAL, cast(try_strptime(BIRTHDATE, '%Y-%m-%d') as date) AS _b FROM patients) p
      ON p.Id = r.patient_id
    JOIN asof_counts a ON a.encounter_id = r.encounter_id""", "readm", "patients", "asof_counts"))
def q_training_features(spark, d):
    return rm.training_features(readm_compute(spark, d), fx.landed(spark, d, "patients"), fx.landed(spark, d, "conditions"),
                                fx.landed(spark, d, "medications"))


@register("risk_levels", W("SELECT * FROM risk", "risk"))
def q_risk_levels(spark, d):
    return risk_compute(spark, d)


@register("top_risk_stay", W("SELECT * FROM top_stay", "top_stay"))
def q_top_risk_stay(spark, d):
    return rm.top_risk_stay(risk(spark, d))


@register("risk_publish", W("SELECT * FROM risk_msgs", "risk_msgs"))
def q_risk_publish(spark, d):
    return rm.risk_messages(rm.top_risk_stay(risk(spark, d)))


@register("risk_decode", W("""
    SELECT "key", rec_offset, CASE WHEN ok THEN patient_id END AS patient_id, CASE WHEN ok THEN risk_level END AS risk_level,
           CASE WHEN ok THEN cast(risk_pct as double) END AS risk_pct,
           CASE WHEN ok THEN readmit_probability END AS readmit_probability,
           CASE WHEN ok THEN '""" + rules.RISK_SOURCE + """' END AS source, NOT ok AS _corrupt
    FROM (SELECT *, rec_offset % 10 <> 0 AS ok FROM risk_msgs JOIN top_stay ON top_stay.patient_id = risk_msgs."key")""",
                               "risk_msgs", "top_stay"))
def q_risk_decode(spark, d):
    """Every tenth message arrives broken and goes to the error branch."""
    msgs = rm.risk_messages(rm.top_risk_stay(risk(spark, d)))
    msgs = msgs.withColumn("value", F.when(F.col("rec_offset") % 10 == 0, F.concat(F.lit("not json "), "value")).otherwise(F.col("value")))
    return stream.decode_json(msgs, stream.RISK_MESSAGE)


@register("risk_latest", W(f"""
    SELECT patient_id, risk_level, cast(risk_pct as double) AS risk_pct, readmit_probability,
           '{rules.RISK_SOURCE}' AS source, TIMESTAMP '{AS_OF}' AS processed_at,
           TIMESTAMP '{AS_OF}' + INTERVAL 86400 SECOND AS expires_at
    FROM top_stay""", "top_stay"))
def q_risk_latest(spark, d):
    return risk_latest(spark, d)


@register("readmission_rate", W("""
    SELECT count(*) AS total_stays, cast(sum(CASE WHEN readmitted_30d = 1 THEN 1 ELSE 0 END) as bigint) AS readmitted,
           CASE WHEN count(*) = 0 THEN 0.0 ELSE round(100.0 * sum(CASE WHEN readmitted_30d = 1 THEN 1 ELSE 0 END)
                / count(*), 1) END AS readmit_rate
    FROM readm""", "readm"))
def q_readmission_rate(spark, d):
    return rm.readmission_rate(readm(spark, d))


_DIST = """
    SELECT coalesce(max(n) FILTER (WHERE risk_level = 'CRITICAL'), 0) AS CRITICAL,
           coalesce(max(n) FILTER (WHERE risk_level = 'HIGH'), 0) AS HIGH,
           coalesce(max(n) FILTER (WHERE risk_level = 'MEDIUM'), 0) AS MEDIUM,
           coalesce(max(n) FILTER (WHERE risk_level = 'LOW'), 0) AS LOW
    FROM (SELECT risk_level, count(DISTINCT patient_id) AS n FROM risk GROUP BY risk_level)"""


@register("risk_distribution", W(f"""
    SELECT *, CRITICAL + HIGH + MEDIUM + LOW AS scored, CRITICAL + HIGH AS at_risk FROM ({_DIST})""", "risk"))
def q_risk_distribution(spark, d):
    return rm.risk_distribution(risk(spark, d))


_DRIVER = """
    SELECT coalesce((SELECT reasondescription FROM t ORDER BY n DESC, reasondescription LIMIT 1), 'Not documented')
             AS top_driver,
           coalesce((SELECT n FROM t ORDER BY n DESC, reasondescription LIMIT 1), 0) AS top_driver_n"""
_DRIVER_T = """t AS (SELECT reasondescription, count(*) AS n FROM readm
             WHERE readmitted_30d = 1 AND reasondescription IS NOT NULL AND trim(reasondescription) <> ''
             GROUP BY reasondescription)"""


@register("top_driver", W(f", {_DRIVER_T} {_DRIVER}", "readm"))
def q_top_driver(spark, d):
    return rm.top_driver_row(readm(spark, d))


@register("undocumented", W("""
    SELECT count(*) AS undocumented FROM readm
    WHERE readmitted_30d = 1 AND (reasondescription IS NULL OR trim(reasondescription) = '')""", "readm"))
def q_undocumented(spark, d):
    return rm.undocumented(readm(spark, d))


@register("exec_summary", W(f""", {_DRIVER_T},
    rate AS (SELECT count(*) AS total_stays,
                    cast(sum(CASE WHEN readmitted_30d = 1 THEN 1 ELSE 0 END) as bigint) AS readmitted FROM readm),
    dist AS ({_DIST}),
    drv AS ({_DRIVER})
    SELECT CASE WHEN total_stays = 0 THEN 0.0 ELSE round(100.0 * readmitted / total_stays, 1) END AS readmit_rate,
           total_stays, readmitted, CRITICAL, HIGH, MEDIUM, LOW, CRITICAL + HIGH + MEDIUM + LOW AS scored,
           CRITICAL + HIGH AS at_risk, (CRITICAL + HIGH) * 15000 AS exposure,
           cast(round((CRITICAL + HIGH) * 15000 * 0.25) as bigint) AS avoidable, top_driver, top_driver_n,
           (SELECT count(*) FROM readm WHERE readmitted_30d = 1
              AND (reasondescription IS NULL OR trim(reasondescription) = '')) AS undocumented
    FROM rate, dist, drv""", "readm", "risk"))
def q_exec_summary(spark, d):
    return rm.exec_summary(readm(spark, d), risk(spark, d))


@register("cohort_averages", W("""
    SELECT round(avg(age_at_admit), 0) AS avg_age, round(avg(prior_admission_count), 1) AS avg_prior_admissions,
           round(avg(condition_count), 1) AS avg_conditions FROM risk""", "risk"))
def q_cohort_averages(spark, d):
    return rm.cohort_averages(risk(spark, d))


@register("risk_explain", W(""", a AS (SELECT round(avg(age_at_admit), 0) AS aa, round(avg(prior_admission_count), 1) AS ap,
                 round(avg(condition_count), 1) AS ac FROM risk)
    SELECT patient_id, risk_level, cast(risk_pct as double) AS risk_pct, readmit_probability, factor, value, "avg", unit
    FROM (SELECT t.*, 'Prior admissions' AS factor, cast(prior_admission_count as double) AS value, a.ap AS "avg",
                 '' AS unit FROM top_stay t, a
          UNION ALL SELECT t.*, 'Chronic conditions', cast(condition_count as double), a.ac, '' FROM top_stay t, a
          UNION ALL SELECT t.*, 'Age at admission', cast(age_at_admit as double), a.aa, 'yrs' FROM top_stay t, a)""",
                             "risk", "top_stay"))
def q_risk_explain(spark, d):
    return rm.risk_explain(risk(spark, d))


@register("drivers_by_condition", W("""
    SELECT condition_name, count(*) AS readmitted_patients
    FROM (SELECT DISTINCT patient_id, condition_name FROM conditions) c
    JOIN (SELECT DISTINCT patient_id FROM readm WHERE readmitted_30d = 1) r USING (patient_id)
    GROUP BY condition_name""", "readm", "conditions"))
def q_drivers_by_condition(spark, d):
    return rm.drivers_by_condition(readm(spark, d), fx.landed(spark, d, "conditions"))


@register("risk_by_age_group", W("""
    SELECT CASE WHEN age_at_admit BETWEEN 0 AND 17 THEN '0-17' WHEN age_at_admit BETWEEN 18 AND 39 THEN '18-39'
                WHEN age_at_admit BETWEEN 40 AND 64 THEN '40-64' WHEN age_at_admit BETWEEN 65 AND 79 THEN '65-79'
                WHEN age_at_admit >= 80 THEN '80+' ELSE 'unknown' END AS age_group,
           count(*) AS stays, count(DISTINCT patient_id) AS patients,
           round(avg(readmit_probability), 4) AS avg_probability, round(avg(actual_label), 4) AS readmit_rate
    FROM risk GROUP BY 1""", "risk"))
def q_risk_by_age_group(spark, d):
    return rm.risk_by_age_group(risk(spark, d))


@register("top10_risk", W("""
    SELECT *, cast(row_number() OVER (ORDER BY readmit_probability DESC, patient_id) as bigint) AS rank
    FROM top_stay ORDER BY readmit_probability DESC, patient_id LIMIT 10""", "top_stay"))
def q_top10_risk(spark, d):
    from wardline.operators.alerts import rank_top
    return rank_top(rm.top_risk_stay(risk(spark, d)), 10, [F.col("readmit_probability").desc(), F.col("patient_id")])


def features(spark, d):
    return rm.training_features(readm(spark, d), fx.landed(spark, d, "patients"), fx.landed(spark, d, "conditions"), fx.landed(spark, d, "medications"))


def stored_features(spark, d):
    """The training features, stored once: fitting reads them many times."""
    return fx.land(spark, d, "features", lambda: features(spark, d))


def model_path(spark, d):
    """Where the fitted model of these inputs is stored; it is fitted if it isn't yet."""
    path = fx.stored_path(spark, d, "readmission-model")
    if not model.fitted(spark, path):
        model.fit(stored_features(spark, d), path)
    return path


@register("readmission_model")
def q_readmission_model(spark, d):
    return model.score(stored_features(spark, d), model_path(spark, d))


@register("adhoc_sql", W("""
    SELECT json_object('risk_level', risk_level, 'stays', count(*), 'avg_pct', round(avg(risk_pct), 2))::varchar
             AS row_json
    FROM risk GROUP BY risk_level""", "risk"))
def q_adhoc_sql(spark, d):
    from wardline.operators.adhoc import adhoc_sql
    risk(spark, d).createOrReplaceTempView("risk_levels")
    return adhoc_sql(spark, "SELECT risk_level, count(*) AS stays, round(avg(risk_pct), 2) AS avg_pct "
                            "FROM risk_levels GROUP BY risk_level ORDER BY risk_level")
