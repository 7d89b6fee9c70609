"""Hand-made edge rows (no driver data): parsing, ranges, trends, TTL,
ages, duplicates, upserts, DLQ thresholds, empty inputs."""

import math

import pytest
from pyspark.sql import functions as F

from wardline.functions.scalar import age_at, fmt_fixed, py_float, py_repr, py_strip
from wardline.operators import alerts as al
from wardline.operators import context as ctx
from wardline.operators import dlq as dq
from wardline.operators import ingest

OBS = "rec_offset long, ingest_ts timestamp, PATIENT string, ENCOUNTER string, DATE string, CODE string, " \
      "DESCRIPTION string, VALUE string, UNITS string"
PAT = "Id string, BIRTHDATE string, GENDER string"


def one_col(spark, vals, typ="string"):
    return spark.createDataFrame([(v,) for v in vals], f"x {typ}")


def test_python_float_parsing(spark):
    vals = ["nan", "inf", "-inf", "1_000", "12d", " 12 ", "", "N/A", "1e3", "Infinity", "1__0", ".5", "5.", "0x10"]
    out = one_col(spark, vals).select(py_float(py_strip(F.col("x"))).alias("v")).collect()
    got = [r.v for r in out]

    def pyf(s):
        try:
            return float(s.strip())
        except ValueError:
            return None
    exp = [pyf(v) for v in vals]
    for g, e, v in zip(got, exp, vals):
        if e is None:
            assert g is None, v
        elif math.isnan(e):
            assert math.isnan(g), v
        else:
            assert g == e, v


def test_python_repr_and_format(spark):
    vals = [15.0, 61.35, 1e7, 1.2345e7, 1e16, 1.5e-5, 0.0005, 123456789012.5, float("inf"), float("nan"), -2.5]
    out = one_col(spark, vals, "double").select(py_repr(F.col("x")).alias("r"), fmt_fixed(F.col("x"), 1).alias("f"),
                                                fmt_fixed(F.col("x"), 0).alias("f0")).collect()
    for r, v in zip(out, vals):
        assert r.r == repr(v), v
        if not math.isinf(v) and not math.isnan(v):
            assert r.f == f"{v:.1f}", v
            assert r.f0 == f"{v:.0f}", v


def test_validator_bounds_and_order(spark):
    obs = spark.createDataFrame([
        (1, None, "P1", "E1", "2024-01-01T00:00:00Z", "8867-4", "HR", "20", "/min"),
        (2, None, "P1", "E1", "2024-01-01T00:00:00Z", "8867-4", "HR", "19.99", "/min"),
        (3, None, "P1", "E1", "2024-01-01T00:00:00Z", "8867-4", "HR", "250", "/min"),
        (4, None, "P1", "E1", "2024-01-01T00:00:00Z", "8867-4", "HR", "250.01", "/min"),
        (5, None, "P1", "E1", "2024-01-01T00:00:00Z", "8867-4", "HR", "nan", "/min"),
        (6, None, "PX123456789", "E1", "", "8867-4", "HR", "12d", "/min"),
        (7, None, "PX123456789", "E1", "", "8867-4", "HR", "80", "/min"),
        (8, None, "P1", "E1", "", "8867-4", "HR", "  ", "/min"),
        (9, None, "P1", "E1", "", "8867-4", "HR", "80", "/min"),
        (10, None, "P1", "E1", "x", "29463-7", "W", "80", "kg"),
    ], OBS)
    pats = spark.createDataFrame([("P1", "1990-01-01", "M")], PAT)
    r = {x.rec_offset: x.error_reason for x in ingest.classify_observations(obs, pats).collect()}
    assert r[1] is None and r[3] is None and r[5] is None
    assert r[2] == "OUT_OF_RANGE: 8867-4 value 19.99 outside valid range [20, 250]"
    assert r[4] == "OUT_OF_RANGE: 8867-4 value 250.01 outside valid range [20, 250]"
    assert r[6] == "INVALID_VALUE: Cannot parse '12d' as number"
    assert r[7] == "UNKNOWN_PATIENT: Patient PX123456... not in patients.csv"
    assert r[8] == "MISSING_VALUE: VALUE field is empty"
    assert r[9] == "MISSING_DATE: DATE field is empty"
    assert r[10] is None  # not a vital: skipped, not rejected


def test_duplicate_patient_last_row_wins(spark):
    pats = spark.createDataFrame([("P1", "1990-01-01", "M"), ("P1", "1980-01-01", "F")], PAT).coalesce(1)
    d = ingest.patients_dim(pats).collect()
    assert len(d) == 1 and d[0].GENDER == "F"


@pytest.mark.parametrize("birth,ref,age", [
    ("2000-03-01", "2024-03-01T10:00:00Z", 24),   # birthday on the day
    ("2000-03-02", "2024-03-01T10:00:00Z", 23),
    ("2000-02-29", "2023-02-28T00:00:00Z", 22),   # Feb 29, no birthday yet
    ("2000-02-29", "2024-02-29", 24),
    ("2030-01-01", "2024-01-01T00:00:00Z", 0),    # birth after observation -> clamp 0
    ("1800-01-01", "2024-01-01T00:00:00Z", 120),  # clamp 120
    ("2000-01-01", "not-a-date", -1),
    ("bad", "2024-01-01", -1),
])
def test_age(spark, birth, ref, age):
    df = spark.createDataFrame([(birth, ref)], "b string, r string")
    assert df.select(age_at(F.col("b"), F.col("r")).alias("a")).first().a == age


def readings(spark, rows):
    return spark.createDataFrame(
        [(p, "heart_rate", o, v, f"t{o}", "/min", 40, "M") for p, o, v in rows],
        "patient_id string, vital string, rec_offset long, value double, timestamp string, units string, "
        "patient_age int, patient_gender string")


def test_trends(spark):
    rows = [("A", 1, 0.0), ("A", 2, 50.0)]                      # first reading 0 -> pct 0
    rows += [("B", 1, 70.0)]                                      # one reading -> no trend
    rows += [("C", i, 60.0 + i) for i in range(1, 12)]            # eleven readings: oldest dropped
    rows += [("D", 1, 80.0), ("D", 2, 90.0), ("D", 3, 80.0)]      # equal first and last
    t = {r.patient_id: r for r in ctx.vital_trends(ctx.vitals_history(readings(spark, rows))).collect()}
    assert t["A"].direction == "rising" and t["A"].pct_change == 0.0 and t["A"].change == 50.0
    assert "B" not in t
    assert t["C"].readings == 10 and t["C"].change == 9.0 and t["C"].pct_change == round(9 / 62 * 100, 2)
    assert t["D"].direction == "stable" and t["D"].change == 0.0


def test_ttl_episodes(spark):
    rows = [("A", "2024-01-01 00:00:00", 1, "v"), ("A", "2024-01-02 00:00:00", 2, "v"),  # exactly 24 h: same
            ("A", "2024-01-03 00:00:00.000001", 3, "v"),                                # just over: new
            ("B", "2024-01-01 00:00:00", 1, "v"), ("B", "2024-01-01 20:00:00", 1, "c"),  # another source refreshes
            ("B", "2024-01-02 19:00:00", 2, "m"), ("B", "2024-01-03 18:00:00", 2, "v"),
            ("C", "2024-01-01 00:00:00", 1, "c"), ("C", "2024-01-05 00:00:00", 2, "c"),
            ("", "2024-01-01 00:00:00", 9, "v"), (None, "2024-01-01 00:00:00", 9, "m"), ("D", None, 9, "v")]
    df = spark.createDataFrame(rows, "patient_id string, ts string, rec_offset long, src string") \
        .withColumn("ingest_ts", F.col("ts").cast("timestamp")).withColumn("updated_at", F.col("ingest_ts"))
    v, c, m = (df.where(F.col("src") == x) for x in "vcm")
    updates = ctx.context_updates(v, c, m)
    ep = ctx.context_episodes(updates).orderBy("patient_id", "episode").collect()
    assert [(e.patient_id, e.updates) for e in ep] == [("A", 2), ("A", 1), ("B", 4), ("C", 1), ("C", 1)]
    starts = ctx.document_starts(updates)
    left = lambda x, t: sorted((r.patient_id, r.rec_offset) for r in ctx.in_document(x, starts, t).collect())
    assert left(v, "ingest_ts") == [("A", 3), ("B", 1), ("B", 2)]
    assert left(c, "updated_at") == [("B", 1), ("C", 2)] and left(m, "updated_at") == [("B", 2)]


def test_condition_resent_and_delete_before_insert(spark):
    log = spark.createDataFrame([
        ("P", 1, "flu", "c1", "active", "mild", "c"),
        ("P", 2, "cold", "c2", "active", "mild", "c"),
        ("P", 3, "flu", "c1", "resolved", "severe", "u"),     # re-sent under the same name
        ("P", 4, "pain", "c3", "active", "mild", "d"),        # delete before insert
        ("P", 5, "pain", "c3", "active", "mild", "c"),
        ("P", 6, "cold", "c2", "active", "mild", "d"),
    ], "patient_id string, rec_offset long, condition_name string, condition_code string, status string, "
       "severity string, op string")
    keep = {r.name: r for r in ctx.upsert_list(log, "condition_name", ["status", "severity"]).collect()}
    assert keep["flu"].status == "resolved" and keep["flu"].first_offset == 1
    assert set(keep) == {"flu", "cold", "pain"}                # deletes ignored by default
    dele = {r.name: r for r in ctx.upsert_list(log, "condition_name", ["status"], op_col="op",
                                               apply_deletes=True).collect()}
    assert set(dele) == {"flu", "pain"} and dele["pain"].first_offset == 5


def dlq_rows(spark, n, reason="OUT_OF_RANGE: x", minutes_ago=1):
    return spark.createDataFrame(
        [(i, reason, "csv_lab_export", f"2024-01-31 00:{59 - minutes_ago}:00", "patient-vitals") for i in range(n)],
        "rec_offset long, error_reason string, source_system string, failed_at string, topic_intended string") \
        .withColumn("failed_at", F.col("failed_at").cast("timestamp"))


@pytest.mark.parametrize("n,sev", [(10, "WARNING"), (11, "CRITICAL"), (0, "INFO")])
def test_recency_thresholds(spark, n, sev):
    r = dq.recency(dlq_rows(spark, n), "2024-01-31 01:00:00").first()
    assert r.severity == sev and r.last_5_minutes == n
    assert r.status == ("CLEAN" if n == 0 else "ERRORS_FOUND")


@pytest.mark.parametrize("n,level", [(20, "WARNING"), (21, "CRITICAL"), (0, "OK")])
def test_alert_level_thresholds(spark, n, level):
    comps = spark.createDataFrame([("c", "RUNNING")], "component string, state string")
    assert dq.alert_level(dlq_rows(spark, n), comps).first().level == level


def test_reason_without_colon(spark):
    cats = dq.by_category(dlq_rows(spark, 3, reason="PRODUCTION_ERROR timeout")).collect()
    assert cats[0].category == "PRODUCTION_ERROR timeout" and cats[0].errors == 3


def test_zero_value_never_alerts(spark):
    cur = spark.createDataFrame([("P", "heart_rate", 0.0, "rising", 50.0), ("P", "temperature", 101.0, "stable", 0.0)],
                                "patient_id string, vital string, value double, direction string, pct_change double")
    r = al.evaluate_alerts(cur).collect()
    assert sorted(x.msg for x in r) == ["Fever: 101.0°F", "Heart rate rising 50.0%"]


def test_empty_inputs(spark):
    obs = spark.createDataFrame([], OBS)
    pats = spark.createDataFrame([], PAT)
    assert ingest.classify_observations(obs, pats).count() == 0
    s = ingest.ingest_stats(ingest.classify_observations(obs, pats)).first()
    assert s.total == 0 and s.produced == 0
    assert ctx.vital_trends(ctx.vitals_history(readings(spark, []))).count() == 0
    r = dq.recency(dlq_rows(spark, 0), "2024-01-31 01:00:00").first()
    assert r.status == "CLEAN"


def test_breakdown_counts_fields_and_other_dimensions(spark):
    from wardline.operators import dlq
    rows = [(1, "OUT_OF_RANGE: 8867-4 value 900", "a", "t"), (2, "MISSING_DATE: DATE field is empty", None, "t"), (3, "disk full", "a", None),
            (4, None, "b", "t"), (5, "OUT_OF_RANGE : x", "a", "t")]
    log = spark.createDataFrame(rows, "rec_offset long, error_reason string, source_system string, topic_intended string")
    got = {(r.dimension, r.value): r.errors for r in dlq.breakdown(dlq.with_field(log)).collect()}
    assert got == {("category", "OUT_OF_RANGE"): 2, ("category", "MISSING_DATE"): 1, ("category", "disk full"): 1, ("category", "unknown"): 1,
                   ("source_system", "a"): 3, ("source_system", "unknown"): 1, ("source_system", "b"): 1,
                   ("topic_intended", "t"): 4, ("topic_intended", "unknown"): 1, ("field", "VALUE"): 2, ("field", "DATE"): 1}
    assert {r.dimension for r in dlq.breakdown(log).collect()} == {"category", "source_system", "topic_intended"}


def test_advice_for_every_class_of_causes(spark):
    from wardline import rules
    from wardline.operators import dlq
    reasons = {"range": "value OUT OF RANGE", "schema": "Avro said no", "missing": "NULL id", "connection": "connection refused", "unknown": "disk full"}
    for name, reason in reasons.items():
        log = spark.createDataFrame([(1, reason), (2, reason), (3, "other")], "rec_offset long, error_reason string")
        got = dlq.diagnosis_advice(log).collect()
        likely, fixes, again = rules.ROOT_CAUSE_ADVICE[name]
        assert [r.text for r in sorted(got, key=lambda r: r.step) if r.part == "fix"] == fixes
        assert {r.text for r in got if r.part != "fix"} == {x for x in (likely, again) if x}
    assert dlq.diagnosis_advice(log.limit(0)).count() == 0
