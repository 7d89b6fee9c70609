"""Patient-context queries: latest values, bounded history, trends, upserted
lists, the three-source merge, TTL episodes and the live view."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.operators import context as ctx
from wardline.plans.fixture_sql import add_fixture, with_fixtures as W
from wardline.plans.q_ingest import enriched
from wardline.plans.registry import register
from wardline.sources import fixtures as fx

AS_OF = fx.AS_OF_EVENTS

add_fixture("readings", ["enriched"], """
    SELECT * FROM (SELECT *, CASE vital_type WHEN '8867-4' THEN 'heart_rate' WHEN '8480-6' THEN 'systolic_bp'
                   WHEN '8462-4' THEN 'diastolic_bp' WHEN '2708-6' THEN 'oxygen_saturation'
                   WHEN '9279-1' THEN 'respiratory_rate' WHEN '8310-5' THEN 'temperature' END AS vital
                   FROM enriched) WHERE vital IS NOT NULL""")
add_fixture("updates", ["readings", "conditions", "medications"], """
    SELECT patient_id, ingest_ts AS t, 0 AS src, cast(rec_offset AS bigint) AS rec_offset FROM readings
    UNION ALL SELECT patient_id, updated_at, 1, rec_offset FROM conditions WHERE coalesce(patient_id, '') <> ''
    UNION ALL SELECT patient_id, updated_at, 2, rec_offset FROM medications WHERE coalesce(patient_id, '') <> ''""")
add_fixture("numbered", ["updates"], """
    SELECT *, sum(_new) OVER (PARTITION BY patient_id ORDER BY t, src, rec_offset
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS episode
    FROM (SELECT *, CASE WHEN lag(t) OVER w IS NULL OR epoch_us(t) - epoch_us(lag(t) OVER w) > 86400000000
                         THEN 1 ELSE 0 END AS _new
          FROM updates WINDOW w AS (PARTITION BY patient_id ORDER BY t, src, rec_offset))""")
add_fixture("episodes", ["numbered"], """
    SELECT patient_id, cast(episode as bigint) AS episode, min(t) AS started_at, max(t) AS last_update,
           count(*) AS updates, max(t) + INTERVAL 86400 SECOND AS expires_at
    FROM numbered GROUP BY patient_id, episode""")
# each source's rows in the patient's newest episode
for _name, _src, _all in (("doc_readings", 0, "readings"), ("doc_conditions", 1, "conditions"), ("doc_medications", 2, "medications")):
    add_fixture(_name, ["numbered", _all], f"""
    SELECT x.* FROM {_all} x JOIN (
      SELECT patient_id, rec_offset FROM numbered
      JOIN (SELECT patient_id, max(episode) AS episode FROM numbered GROUP BY patient_id) USING (patient_id, episode)
      WHERE src = {_src}) USING (patient_id, rec_offset)""")
add_fixture("live", ["episodes"], f"""
    SELECT patient_id, episode, started_at, last_update, updates, expires_at
    FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY episode DESC) AS _r FROM episodes)
    WHERE _r = 1 AND expires_at >= TIMESTAMP '{AS_OF}'""")
add_fixture("history", ["doc_readings"], """
    SELECT * FROM (SELECT patient_id, vital, rec_offset, value, "timestamp",
                   cast(row_number() OVER (PARTITION BY patient_id, vital ORDER BY rec_offset DESC) as integer) AS rn
                   FROM doc_readings) WHERE rn <= 10""")
add_fixture("trends", ["history"], """
    SELECT patient_id, vital,
           CASE WHEN isnan(_last - _first) THEN 'stable' WHEN _last - _first > 0 THEN 'rising'
                WHEN _last - _first < 0 THEN 'falling' ELSE 'stable' END AS direction,
           round(_last - _first, 2) AS change,
           round(CASE WHEN _first <> 0 THEN (_last - _first) / _first * 100 ELSE 0.0 END, 2) AS pct_change,
           readings
    FROM (SELECT patient_id, vital, count(*) AS readings, arg_min(value, rec_offset) AS _first,
                 arg_max(value, rec_offset) AS _last
          FROM history GROUP BY patient_id, vital HAVING count(*) >= 2)""")
add_fixture("latest", ["doc_readings"], """
    SELECT patient_id, vital, arg_max(value, rec_offset) AS value, arg_max(units, rec_offset) AS units,
           arg_max("timestamp", rec_offset) AS "timestamp", max(rec_offset) AS rec_offset
    FROM doc_readings GROUP BY patient_id, vital""")
add_fixture("current", ["latest", "trends"], """
    SELECT l.patient_id, l.vital, l.value, l.units, l."timestamp", t.direction IS NOT NULL AS has_trend,
           coalesce(t.direction, 'stable') AS direction, coalesce(t.pct_change, 0.0) AS pct_change
    FROM latest l LEFT JOIN trends t ON l.patient_id = t.patient_id AND l.vital = t.vital""")
add_fixture("lconds", ["conditions"], """
    SELECT patient_id, condition_name AS name, arg_max(condition_code, rec_offset) AS condition_code,
           arg_max(status, rec_offset) AS status, arg_max(severity, rec_offset) AS severity,
           min(rec_offset) AS first_offset, max(rec_offset) AS last_offset
    FROM conditions WHERE coalesce(patient_id, '') <> '' GROUP BY patient_id, condition_name""")
add_fixture("doc_lconds", ["doc_conditions"], """
    SELECT patient_id, condition_name AS name, arg_max(condition_code, rec_offset) AS condition_code,
           arg_max(status, rec_offset) AS status, arg_max(severity, rec_offset) AS severity,
           min(rec_offset) AS first_offset, max(rec_offset) AS last_offset
    FROM doc_conditions WHERE coalesce(patient_id, '') <> '' GROUP BY patient_id, condition_name""")
add_fixture("lmeds", ["medications"], """
    SELECT patient_id, medication_name AS name, arg_max(dosage, rec_offset) AS dosage,
           arg_max(frequency, rec_offset) AS frequency, arg_max(route, rec_offset) AS route,
           arg_max(status, rec_offset) AS status, min(rec_offset) AS first_offset, max(rec_offset) AS last_offset
    FROM medications WHERE coalesce(patient_id, '') <> '' GROUP BY patient_id, medication_name""")
add_fixture("doc_lmeds", ["doc_medications"], """
    SELECT patient_id, medication_name AS name, arg_max(dosage, rec_offset) AS dosage,
           arg_max(frequency, rec_offset) AS frequency, arg_max(route, rec_offset) AS route,
           arg_max(status, rec_offset) AS status, min(rec_offset) AS first_offset, max(rec_offset) AS last_offset
    FROM doc_medications WHERE coalesce(patient_id, '') <> '' GROUP BY patient_id, medication_name""")
add_fixture("context", ["doc_readings", "doc_lconds", "doc_lmeds"], """
    SELECT coalesce(v.patient_id, c.patient_id, m.patient_id) AS patient_id,
           coalesce(v.patient_age, 0) AS patient_age, coalesce(v.patient_gender, '') AS patient_gender,
           coalesce(v.vital_count, 0) AS vital_count, coalesce(v.vital_readings, 0) AS vital_readings,
           coalesce(c.n, 0) AS condition_count, coalesce(m.n, 0) AS medication_count,
           coalesce(c.names, '[]') AS conditions, coalesce(m.names, '[]') AS medications
    FROM (SELECT patient_id, arg_max(patient_age, rec_offset) AS patient_age,
                 arg_max(patient_gender, rec_offset) AS patient_gender, count(DISTINCT vital) AS vital_count,
                 count(*) AS vital_readings
          FROM doc_readings GROUP BY patient_id) v
    FULL OUTER JOIN (SELECT patient_id, count(*) AS n, to_json(list(name ORDER BY first_offset))::varchar AS names
                     FROM doc_lconds GROUP BY patient_id) c ON v.patient_id = c.patient_id
    FULL OUTER JOIN (SELECT patient_id, count(*) AS n, to_json(list(name ORDER BY first_offset))::varchar AS names
                     FROM doc_lmeds GROUP BY patient_id) m ON coalesce(v.patient_id, c.patient_id) = m.patient_id""")
add_fixture("context_now", ["context", "live"], "SELECT c.*, l.last_update FROM context c JOIN live l USING (patient_id)")
add_fixture("current_now", ["current", "live"], "SELECT * FROM current WHERE patient_id IN (SELECT patient_id FROM live)")
def readings(spark, d):
    return ctx.vital_readings(enriched(spark, d))


def updates(spark, d):
    return ctx.context_updates(readings(spark, d), fx.landed(spark, d, "conditions"), fx.landed(spark, d, "medications"))


def newest(spark, d):
    """The stored newest episode of each patient: the documents, alive or not."""
    return fx.land(spark, d, "newest", lambda: ctx.newest_episode(ctx.context_episodes(updates(spark, d))))


def starts(spark, d):
    """The start of each patient's newest document."""
    return newest(spark, d).select("patient_id", "started_at")


def doc_sources(spark, d):
    """The three sources without what expired."""
    s = starts(spark, d)
    return (ctx.in_document(readings(spark, d), s, "ingest_ts"), ctx.in_document(fx.landed(spark, d, "conditions"), s, "updated_at"),
            ctx.in_document(fx.landed(spark, d, "medications"), s, "updated_at"))


def doc_readings(spark, d):
    return ctx.in_document(readings(spark, d), starts(spark, d), "ingest_ts")


def context_compute(spark, d):
    return ctx.patient_context(*doc_sources(spark, d))


def current_compute(spark, d):
    return ctx.current_vitals(doc_readings(spark, d))


def seen(spark, d):
    """The stored count of readings of every patient that any source has named,
    expired or not."""
    def build():
        r = readings(spark, d)
        ids = ctx.all_patients(r, fx.landed(spark, d, "conditions"), fx.landed(spark, d, "medications"))
        return ids.join(r.groupBy("patient_id").agg(F.count(F.lit(1)).alias("vital_readings")), "patient_id", "left")
    return fx.land(spark, d, "seen", build)


def live(spark, d):
    """The stored documents that are alive at the reading time."""
    return ctx.context_live(newest(spark, d), AS_OF)


def context(spark, d):
    """The stored per-patient context table (what the streaming fold keeps),
    built by ``patient_context`` once, without expired documents and with the
    time of the last update."""
    stored = fx.land(spark, d, "context", lambda: context_compute(spark, d))
    return stored.join(live(spark, d).select("patient_id", "last_update"), "patient_id")


def current(spark, d):
    """Stored current vitals with trends (latest + trend per patient x vital) of
    the documents that are alive."""
    stored = fx.land(spark, d, "current", lambda: current_compute(spark, d))
    return stored.join(live(spark, d).select("patient_id"), "patient_id", "left_semi")


@register("latest_vitals", W("SELECT * FROM latest", "latest"))
def q_latest_vitals(spark, d):
    return ctx.latest_vitals(doc_readings(spark, d))


@register("vitals_history", W("SELECT * FROM history", "history"))
def q_vitals_history(spark, d):
    return ctx.vitals_history(doc_readings(spark, d))


@register("vital_trends", W("SELECT * FROM trends", "trends"))
def q_vital_trends(spark, d):
    return ctx.vital_trends(ctx.vitals_history(doc_readings(spark, d)))


@register("patient_summary", W("SELECT * FROM current", "current"))
def q_patient_summary(spark, d):
    return current_compute(spark, d).select("patient_id", "vital", "value", "units", "timestamp", "has_trend",
                                    "direction", "pct_change")


@register("latest_conditions", W("SELECT * FROM lconds", "lconds"))
def q_latest_conditions(spark, d):
    return ctx.latest_conditions(fx.landed(spark, d, "conditions"))


@register("latest_medications", W("SELECT * FROM lmeds", "lmeds"))
def q_latest_medications(spark, d):
    return ctx.latest_medications(fx.landed(spark, d, "medications"))


@register("latest_medications_deletes", W("""
    SELECT g.patient_id, g.name, g.dosage, g.frequency, g.route, g.status,
           (SELECT min(x.rec_offset) FROM medications x
             WHERE x.patient_id = g.patient_id AND x.medication_name = g.name
               AND (g._del IS NULL OR x.rec_offset > g._del)) AS first_offset,
           g.last_offset
    FROM (SELECT patient_id, medication_name AS name, arg_max(dosage, rec_offset) AS dosage,
                 arg_max(frequency, rec_offset) AS frequency, arg_max(route, rec_offset) AS route,
                 arg_max(status, rec_offset) AS status, arg_max(op, rec_offset) AS _op,
                 max(CASE WHEN op = 'd' THEN rec_offset END) AS _del, max(rec_offset) AS last_offset
          FROM medications WHERE coalesce(patient_id, '') <> '' GROUP BY patient_id, medication_name) g
    WHERE g._op <> 'd'""", "medications"))
def q_latest_medications_deletes(spark, d):
    return ctx.latest_medications(fx.landed(spark, d, "medications"), apply_deletes=True)


@register("patient_context", W("SELECT * FROM context", "context"))
def q_patient_context(spark, d):
    c = context_compute(spark, d)
    return c.withColumn("conditions", F.to_json("conditions")).withColumn("medications", F.to_json("medications"))


@register("patient_context_doc")
def q_patient_context_doc(spark, d):
    doc = ctx.context_document(*doc_sources(spark, d))
    return doc.select("patient_id", "patient_age", "patient_gender",
                      *[F.to_json(c).alias(c) for c in ("vitals", "vitals_history", "conditions", "medications")])


@register("context_episodes", W("SELECT * FROM episodes", "episodes"))
def q_context_episodes(spark, d):
    return ctx.context_episodes(updates(spark, d))


@register("context_live", W("SELECT * FROM live", "live"))
def q_context_live(spark, d):
    return ctx.context_live(ctx.context_episodes(updates(spark, d)), AS_OF)


@register("all_patients", W("""
    SELECT patient_id FROM readings UNION SELECT patient_id FROM conditions
    UNION SELECT patient_id FROM medications""", "readings", "conditions", "medications"))
def q_all_patients(spark, d):
    return ctx.all_patients(readings(spark, d), fx.landed(spark, d, "conditions"), fx.landed(spark, d, "medications"))


@register("total_patients", W("""
    SELECT count(DISTINCT patient_id) AS total_patients FROM (
      SELECT patient_id FROM readings UNION ALL SELECT patient_id FROM conditions
      UNION ALL SELECT patient_id FROM medications)""", "readings", "conditions", "medications"))
def q_total_patients(spark, d):
    ids = ctx.all_patients(readings(spark, d), fx.landed(spark, d, "conditions"), fx.landed(spark, d, "medications"))
    return ids.agg(F.count(F.lit(1)).alias("total_patients"))
