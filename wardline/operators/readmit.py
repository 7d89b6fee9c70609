"""Readmission mart: stays -> readmissions -> features -> risk levels, and
the executive / explainability read models over them.

Per-patient sequences (next admission, prior admissions, as-of counts) are
window functions over the patient's stays in admit order.  Scalar roll-ups
are one-row partial aggregates referenced as scalar subqueries, never cross
joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline import rules
from wardline.functions.scalar import age_years, parse_birthdate
from wardline.operators.sequence import sequence_ops

KEY = "patient_id"
# --- fixed values (ours; the reference ships none): risk bands and ages ---
RISK_CUTS = (25, 50, 75)
AGE_GROUPS = [(0, 17, "0-17"), (18, 39, "18-39"), (40, 64, "40-64"), (65, 79, "65-79"), (80, None, "80+")]
COST_PER_READMISSION = 15000
AVOIDABLE_SHARE = 0.25


def readmissions(stays: DataFrame, days: int = 30) -> DataFrame:
    """Adds next admission gap and the readmitted flag (next admit 0..days
    days after discharge, both ends included; overlaps and last stays = 0),
    the prior admission count and the length of stay.

    The per-patient order (admit time, encounter) is evaluated with the
    bucketed sequence primitive, so a patient with a very large
    number of stays is spread over many tasks."""
    seq = sequence_ops(stays, KEY, ["admit_time", "encounter_id"], row_number="_rn",
                       leads={"_next_admit": "admit_time"})
    gap = F.datediff(F.col("_next_admit"), F.col("discharge_time"))
    return seq.select(
        *stays.columns,
        gap.alias("days_to_next_admit"),
        F.when(gap.between(0, days), 1).otherwise(0).alias("readmitted_30d"),
        (F.col("_rn") - 1).cast("int").alias("prior_admission_count"),
        F.datediff(F.col("discharge_time"), F.col("admit_time")).alias("length_of_stay_days"),
    )


def as_of_distinct_count(stays: DataFrame, log: DataFrame, name_col: str, ts_col: str, out: str) -> DataFrame:
    """Per stay: distinct ``name_col`` values of the patient's log with
    ``ts_col <= admit_time``.

    Each (patient, name) contributes once at its first time (partial min);
    stays and first-times are merged in time order and a running sum counts
    the names seen so far -- linear in the input, no stay x log pairs.
    """
    first = log.groupBy(KEY, name_col).agg(F.min(ts_col).alias("_t")).select(
        KEY, "_t", F.lit(0).alias("_kind"), F.lit(1).alias("_inc"), F.lit(None).cast("long").alias("encounter_id"))
    st = stays.select(KEY, F.col("admit_time").alias("_t"), F.lit(1).alias("_kind"), F.lit(0).alias("_inc"),
                      "encounter_id")
    weigh = log.select(KEY).unionAll(stays.select(KEY))  # at least as many as first times
    u = sequence_ops(first.unionByName(st), KEY, ["_t", "_kind", "encounter_id"], running_sums={out: "_inc"}, weigh=weigh)
    return u.where(F.col("_kind") == 1).select("encounter_id", F.col(out).cast("long").alias(out))


def risk_band(pct: Column, cuts=RISK_CUTS) -> Column:
    lo, mid, hi = cuts
    return (F.when(pct >= hi, "CRITICAL").when(pct >= mid, "HIGH").when(pct >= lo, "MEDIUM").otherwise("LOW"))


def scored_stays(readm: DataFrame, patients: DataFrame, conditions: DataFrame, medications: DataFrame) -> DataFrame:
    """Stays of known patients with the model features and a deterministic
    stand-in score (``risk_pct``), probability and band."""
    p = patients.select(F.col("Id").alias(KEY), parse_birthdate(F.col("BIRTHDATE")).alias("_bd"))
    cc = as_of_distinct_count(readm, conditions, "condition_name", "updated_at", "condition_count")
    mc = as_of_distinct_count(readm, medications, "medication_name", "updated_at", "medication_count")
    j = readm.join(p, KEY).join(cc, "encounter_id", "left").join(mc, "encounter_id", "left")
    age = age_years(F.col("_bd"), F.col("admit_time").cast("date"))
    j = j.withColumn("age_at_admit", age) \
        .withColumn("condition_count", F.coalesce("condition_count", F.lit(0)).cast("long")) \
        .withColumn("medication_count", F.coalesce("medication_count", F.lit(0)).cast("long"))
    pct = F.least(F.lit(99), F.lit(2) + 4 * F.col("prior_admission_count") + F.col("condition_count")
                  + F.col("age_at_admit") % 40).cast("int")
    return j.select(
        "encounter_id", KEY, "age_at_admit", "prior_admission_count", "condition_count", "medication_count",
        "length_of_stay_days", "readmitted_30d", "total_claim_cost",
        pct.alias("risk_pct"), (pct.cast("double") / 100).alias("readmit_probability"),
        risk_band(pct).alias("risk_level"), F.col("readmitted_30d").alias("actual_label"))


def training_features(readm: DataFrame, patients: DataFrame, conditions: DataFrame,
                      medications: DataFrame) -> DataFrame:
    """One row per stay with patient attributes (left join: unknown patients
    keep null attributes) and as-of condition / medication counts."""
    p = patients.select(F.col("Id").alias(KEY), parse_birthdate(F.col("BIRTHDATE")).alias("_bd"),
                        F.col("GENDER").alias("gender"), F.col("MARITAL").alias("marital"))
    cc = as_of_distinct_count(readm, conditions, "condition_name", "updated_at", "condition_count")
    mc = as_of_distinct_count(readm, medications, "medication_name", "updated_at", "medication_count")
    j = readm.join(p, KEY, "left").join(cc, "encounter_id", "left").join(mc, "encounter_id", "left")
    return j.select(
        "encounter_id", KEY, age_years(F.col("_bd"), F.col("admit_time").cast("date")).alias("age_at_admit"),
        "gender", "marital", "length_of_stay_days", "prior_admission_count",
        F.coalesce("condition_count", F.lit(0)).cast("long").alias("condition_count"),
        F.coalesce("medication_count", F.lit(0)).cast("long").alias("medication_count"),
        "total_claim_cost", "readmitted_30d")


def top_risk_stay(risk: DataFrame) -> DataFrame:
    """Highest-probability stay per patient (lowest encounter id on ties), as
    a partial ``max_by`` aggregate -- no per-patient sort."""
    order = F.struct(F.col("readmit_probability"), (-F.col("encounter_id")).alias("_e"))
    cols = [c for c in risk.columns if c != KEY]
    g = risk.groupBy(KEY).agg(F.max_by(F.struct(*cols), order).alias("_s"))
    return g.select(KEY, *[F.col(f"_s.{c}").alias(c) for c in cols])


def risk_messages(top: DataFrame, source: str = rules.RISK_SOURCE) -> DataFrame:
    """Risk score messages keyed by patient; null fields are written as null."""
    body = F.struct(F.col(KEY), F.col("risk_level"), F.col("risk_pct").cast("double").alias("risk_pct"),
                    F.col("readmit_probability").cast("double").alias("readmit_probability"),
                    F.lit(source).alias("source"))
    return top.select(F.col(KEY).alias("key"), F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
                      F.col("encounter_id").alias("rec_offset"))


def risk_store(decoded: DataFrame, processed_at: str, ttl_seconds: int = rules.CONTEXT_TTL_SECONDS) -> DataFrame:
    """Keyed risk store: the last message per patient wins (by offset),
    missing fields stay null, entries expire ``ttl_seconds`` after processing."""
    ok = decoded.where(~F.col("_corrupt") & F.col(KEY).isNotNull())
    g = ok.groupBy(KEY).agg(F.max_by(F.struct("risk_level", "risk_pct", "readmit_probability", "source"),
                                     F.col("rec_offset")).alias("_r"))
    t = F.lit(processed_at).cast("timestamp")
    return g.select(KEY, "_r.*", t.alias("processed_at"),
                    (t + F.make_dt_interval(secs=F.lit(ttl_seconds))).alias("expires_at"))


def readmission_rate(readm: DataFrame) -> DataFrame:
    return readm.agg(F.count(F.lit(1)).alias("total_stays"),
                     F.sum(F.when(F.col("readmitted_30d") == 1, 1).otherwise(0)).cast("long").alias("readmitted")) \
        .withColumn("readmit_rate", F.when(F.col("total_stays") == 0, F.lit(0.0)).otherwise(
            F.round(100.0 * F.col("readmitted") / F.col("total_stays"), 1)))


_LEVELS = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]


def risk_distribution(risk: DataFrame) -> DataFrame:
    """Distinct patients per level (a patient with stays in two levels counts
    in both), missing levels 0, scored and at-risk totals."""
    per = risk.groupBy("risk_level").agg(F.count_distinct(KEY).alias("n"))
    row = per.groupBy().pivot("risk_level", _LEVELS).agg(F.first("n")).fillna(0)
    c = {lv: F.coalesce(F.col(lv), F.lit(0)).cast("long") for lv in _LEVELS}
    return row.select(*[c[lv].alias(lv) for lv in _LEVELS],
                      sum(c.values()).alias("scored"), (c["CRITICAL"] + c["HIGH"]).alias("at_risk"))


def _documented(col: str = "reasondescription") -> Column:
    return F.col(col).isNotNull() & (F.trim(F.col(col)) != "")


def top_driver_row(readm: DataFrame) -> DataFrame:
    r = readm.where((F.col("readmitted_30d") == 1) & _documented())
    per = r.groupBy("reasondescription").agg(F.count(F.lit(1)).alias("n"))
    top = per.orderBy(F.col("n").desc(), F.col("reasondescription")).limit(1)
    # one-row result even when nothing is documented
    name = top.agg(F.first("reasondescription")).scalar()
    n = top.agg(F.first("n")).scalar()
    return readm.agg(F.count(F.lit(1)).alias("_x")).select(
        F.coalesce(name, F.lit("Not documented")).alias("top_driver"),
        F.coalesce(n, F.lit(0)).cast("long").alias("top_driver_n"))


def undocumented(readm: DataFrame) -> DataFrame:
    return readm.agg(F.count_if((F.col("readmitted_30d") == 1) & ~_documented()).alias("undocumented"))


def exec_summary(readm: DataFrame, risk: DataFrame, cost: int = COST_PER_READMISSION,
                 avoidable_share: float = AVOIDABLE_SHARE) -> DataFrame:
    """Executive summary in one row: readmission rate, risk distribution,
    exposure, top driver, undocumented readmissions."""
    rate = readmission_rate(readm)
    dist = risk_distribution(risk)
    drv = top_driver_row(readm)
    und = undocumented(readm)

    def s(df: DataFrame, c: str) -> Column:
        return df.select(c).scalar()

    at_risk = s(dist, "at_risk")
    exposure = at_risk * cost
    return rate.select(
        "readmit_rate", "total_stays", "readmitted",
        *[s(dist, lv).alias(lv) for lv in _LEVELS],
        s(dist, "scored").alias("scored"), at_risk.alias("at_risk"),
        exposure.cast("long").alias("exposure"),
        F.round(exposure * avoidable_share).cast("long").alias("avoidable"),
        s(drv, "top_driver").alias("top_driver"), s(drv, "top_driver_n").alias("top_driver_n"),
        s(und, "undocumented").alias("undocumented"))


def cohort_averages(risk: DataFrame) -> DataFrame:
    return risk.agg(F.round(F.avg("age_at_admit"), 0).alias("avg_age"),
                    F.round(F.avg("prior_admission_count"), 1).alias("avg_prior_admissions"),
                    F.round(F.avg("condition_count"), 1).alias("avg_conditions"))


def risk_explain(risk: DataFrame) -> DataFrame:
    """Per patient (top stay): three factors against the cohort averages,
    one row per factor (``stack`` unpivot); the averages are scalar subqueries."""
    top = top_risk_stay(risk)
    avg = cohort_averages(risk)
    a = {c: avg.select(c).scalar() for c in ("avg_age", "avg_prior_admissions", "avg_conditions")}
    t = top.select(KEY, "risk_level", "risk_pct", "readmit_probability",
                   F.col("prior_admission_count").cast("double").alias("_p"),
                   F.col("condition_count").cast("double").alias("_c"),
                   F.col("age_at_admit").cast("double").alias("_a"),
                   a["avg_prior_admissions"].alias("_ap"), a["avg_conditions"].alias("_ac"),
                   a["avg_age"].alias("_aa"))
    return t.selectExpr(
        KEY, "risk_level", "cast(risk_pct as double) as risk_pct", "readmit_probability",
        "stack(3, 'Prior admissions', _p, _ap, '', 'Chronic conditions', _c, _ac, '', "
        "'Age at admission', _a, _aa, 'yrs') as (factor, value, avg, unit)")


def drivers_by_condition(readm: DataFrame, conditions: DataFrame) -> DataFrame:
    """Conditions of readmitted patients: distinct readmitted patients per
    condition name.  Both sides are de-duplicated to (patient) and (patient,
    name) first, so the join emits each (patient, name) once."""
    pts = readm.where(F.col("readmitted_30d") == 1).select(KEY).distinct()
    names = conditions.select(KEY, "condition_name").distinct()
    return names.join(pts, KEY).groupBy("condition_name").agg(F.count(F.lit(1)).alias("readmitted_patients"))


def age_group(age: Column) -> Column:
    out = None
    for lo, hi, name in AGE_GROUPS:
        c = (age >= lo) if hi is None else age.between(lo, hi)
        out = F.when(c, name) if out is None else out.when(c, name)
    return out.otherwise("unknown")


def risk_by_age_group(risk: DataFrame) -> DataFrame:
    return risk.groupBy(age_group(F.col("age_at_admit")).alias("age_group")).agg(
        F.count(F.lit(1)).alias("stays"), F.count_distinct(KEY).alias("patients"),
        F.round(F.avg("readmit_probability"), 4).alias("avg_probability"),
        F.round(F.avg("actual_label"), 4).alias("readmit_rate"))


def risk_fixture(spark: SparkSession, d: str) -> DataFrame:
    from wardline.sources import fixtures as fx
    return scored_stays(readmissions(fx.landed(spark, d, "stays")), fx.landed(spark, d, "patients"),
                        fx.landed(spark, d, "conditions"), fx.landed(spark, d, "medications"))
