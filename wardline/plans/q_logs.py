"""Log upkeep queries: topic sizes, compaction, retention, de-duplication,
touch-on-update upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.operators import context as ctx
from wardline.operators import logs
from wardline.plans.fixture_sql import add_fixture, with_fixtures as W
from wardline.plans.registry import register
from wardline.sources import fixtures as fx

AS_OF = fx.AS_OF_EVENTS

# --- fixed values (fixture): event type -> topic of the clinical platform
EVENT_TOPICS = [
    ("click", "patient-vitals"), ("view", "patient-conditions"), ("purchase", "patient-medications"),
    ("signup", "integration-health"), ("error", "dead-letter-queue"),
]

add_fixture("routed_log", ["topic_log"], "SELECT * REPLACE (CASE topic " + " ".join(
    f"WHEN '{a}' THEN '{b}'" for a, b in EVENT_TOPICS) + " ELSE topic END AS topic) FROM topic_log")


def routed_log(spark, d):
    log = fx.landed(spark, d, "topic_log")
    t = None
    for a, b in EVENT_TOPICS:
        t = F.when(F.col("topic") == a, b) if t is None else t.when(F.col("topic") == a, b)
    return log.withColumn("topic", t.otherwise(F.col("topic")))


@register("topic_sizes", W("""
    SELECT topic, cast(sum(end_offset) as bigint) AS total_messages
    FROM (SELECT topic, "partition", max("offset") + 1 AS end_offset FROM topic_log GROUP BY ALL) GROUP BY topic""",
                           "topic_log"))
def q_topic_sizes(spark, d):
    return logs.topic_sizes(fx.landed(spark, d, "topic_log"))


@register("compact_log", W(f"""
    SELECT * FROM topic_log WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 3600 SECOND
    UNION ALL BY NAME
    SELECT * FROM (SELECT topic, "partition", "key", arg_max("offset", "offset") AS "offset",
                          arg_max_null("value", "offset") AS "value", arg_max(ts, "offset") AS ts
                   FROM topic_log WHERE ts < TIMESTAMP '{AS_OF}' - INTERVAL 3600 SECOND GROUP BY ALL)
    WHERE "value" IS NOT NULL""", "topic_log"))
def q_compact_log(spark, d):
    return logs.compact_log(fx.landed(spark, d, "topic_log"), AS_OF)


@register("retain", W(f"""
    SELECT l.* FROM routed_log l
    LEFT JOIN (VALUES ('patient-vitals', 30), ('patient-conditions', 90), ('patient-medications', 90),
                      ('integration-health', 7), ('risk-alerts', 90), ('dead-letter-queue', NULL))
              r(topic, days) USING (topic)
    WHERE r.days IS NULL OR l.ts >= TIMESTAMP '{AS_OF}' - to_days(cast(r.days as integer))""", "routed_log"))
def q_retain(spark, d):
    return logs.retain(routed_log(spark, d), logs.retention_df(spark), AS_OF)


@register("dedup_events", W("""
    SELECT source_system, rec_offset, PATIENT, CODE, VALUE FROM observations""", "observations"))
def q_dedup_events(spark, d):
    obs = fx.landed(spark, d, "observations").select("source_system", "rec_offset", "PATIENT", "CODE", "VALUE")
    # producer retries re-send some records; the operator removes them again
    resent = obs.where(F.col("rec_offset") % 50 == 0)
    return logs.dedup_events(obs.unionByName(resent), ["source_system", "rec_offset"])


@register("upsert_touch", W("""
    , tgt AS (SELECT patient_id, name, dosage, status, last_offset AS rec_offset, TIMESTAMP '2001-01-01' AS updated_at
              FROM (SELECT patient_id, medication_name AS name, arg_max(dosage, rec_offset) AS dosage,
                           arg_max(status, rec_offset) AS status, max(rec_offset) AS last_offset
                    FROM medications WHERE op = 'c' GROUP BY ALL)),
    upd AS (SELECT patient_id, name, dosage, status, last_offset AS rec_offset, TIMESTAMP '2001-06-01' AS updated_at
            FROM (SELECT patient_id, medication_name AS name, arg_max(dosage, rec_offset) AS dosage,
                         arg_max(status, rec_offset) AS status, max(rec_offset) AS last_offset
                  FROM medications WHERE op = 'u' GROUP BY ALL))
    SELECT * FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u.patient_id = t.patient_id AND u.name = t.name)
    UNION ALL
    SELECT u.patient_id, u.name, u.dosage, u.status, u.rec_offset,
           CASE WHEN EXISTS (SELECT 1 FROM tgt t WHERE u.patient_id = t.patient_id AND u.name = t.name)
                THEN TIMESTAMP '2001-11-05 00:00:00' ELSE u.updated_at END AS updated_at
    FROM upd u""", "medications"))
def q_upsert_touch(spark, d):
    m = fx.landed(spark, d, "medications")

    def state(op, ts):
        s = ctx.upsert_list(m.where(F.col("op") == op), "medication_name", ["dosage", "status"])
        return s.select("patient_id", "name", "dosage", "status", F.col("last_offset").alias("rec_offset"),
                        F.lit(ts).cast("timestamp").alias("updated_at"))
    return logs.upsert_touch(state("c", "2001-01-01"), state("u", "2001-06-01"), ["patient_id", "name"],
                             fx.AS_OF_ORDERS)
