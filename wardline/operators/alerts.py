"""Alert rules over the current vitals, patient lists and the action queue.

Rules are data (``wardline.rules``); one evaluator turns a rule set into a
single projection with an ``array_compact`` of per-rule structs, exploded to
reason rows.  Each patient has at most one row per vital and a fixed number
of rules, so per-patient reason lists are bounded by the rule count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import rules
from wardline.functions.scalar import fmt_fixed, py_repr
from wardline.operators.sequence import global_rank, spread

KEY = "patient_id"


def _message(template: str, value: Column, pct: Column) -> Column:
    parts: list[Column] = []
    rest = template
    subs = {"{v0}": lambda: fmt_fixed(value, 0), "{v1}": lambda: fmt_fixed(value, 1),
            "{p1}": lambda: fmt_fixed(pct, 1), "{v}": lambda: py_repr(value)}
    while rest:
        hits = [(rest.find(k), k) for k in subs if rest.find(k) >= 0]
        if not hits:
            parts.append(F.lit(rest))
            break
        i, k = min(hits)
        if i:
            parts.append(F.lit(rest[:i]))
        parts.append(subs[k]())
        rest = rest[i + len(k):]
    return F.concat(*parts)


def _condition(vital: str, kind: str, op: str, thr: float) -> Column:
    v, pct = F.col("value"), F.abs(F.col("pct_change"))
    same = F.col("vital") == vital
    if kind == "value":
        # "value and value > t": a zero or missing value never fires; NaN
        # compares false in Python but sorts high in Spark, so it is excluded
        ok = v.isNotNull() & (v != 0) & ~F.isnan(v)
        return same & ok & ((v > thr) if op == ">" else (v < thr))
    return same & (F.col("direction") == op) & ~F.isnan(pct) & (pct > thr)


def evaluate_alerts(current: DataFrame, rule_set=None) -> DataFrame:
    """Reason rows ``(patient_id, vital, rule, type, msg)`` from current
    vitals ``(patient_id, vital, value, direction, pct_change)``."""
    rule_set = rule_set or rules.DASHBOARD_ALERT_RULES
    pct = F.abs(F.col("pct_change"))
    hits = [F.when(_condition(vn, kind, op, thr),
                   F.struct(F.lit(i).alias("rule"), F.lit(typ).alias("type"),
                            _message(tmpl, F.col("value"), pct).alias("msg")))
            for i, (vn, kind, op, thr, typ, tmpl) in enumerate(rule_set)]
    names = sorted({r[0] for r in rule_set})
    x = current.where(F.col("vital").isin(names)).select(
        KEY, "vital", F.explode(F.array_compact(F.array(*hits))).alias("_r"))
    return x.select(KEY, "vital", "_r.rule", "_r.type", "_r.msg")


def alert_summary(reasons: DataFrame) -> DataFrame:
    """Per flagged patient: number of reasons and severity (critical if any
    reason is critical).  Sort: most reasons first, critical before warning."""
    return reasons.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n_reasons"),
        F.when(F.max((F.col("type") == "critical").cast("int")) == 1, "critical").otherwise("warning")
        .alias("severity"),
    )


def ranked_alerts(summary: DataFrame, ids: DataFrame) -> DataFrame:
    """Alert rows with their rank: most reasons first, critical before warning, then
    patient.  ``ids`` are patients that tell how to spread ties over tasks."""
    keyed = summary.withColumn("_less", -F.col("n_reasons"))
    return global_rank(keyed, ["_less", "severity", KEY], [F.col("_less"), (F.col("severity") != "critical").cast("long"), spread(ids, KEY)]).drop("_less")


def rank_top(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """Top-n with a rank: ``orderBy().limit(n)`` (per-task top-n, one merge of
    n rows), then ranks on those n rows only."""
    from pyspark.sql import Window
    top = df.orderBy(*order).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long"))


def attention_top(reasons: DataFrame, n: int = 20) -> DataFrame:
    """Patients needing attention: top n by number of reasons (patient id as
    tiebreak) with the total number flagged (a scalar subquery)."""
    per = reasons.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_reasons"))
    total = per.agg(F.count(F.lit(1))).scalar()
    top = rank_top(per, n, [F.col("n_reasons").desc(), F.col(KEY)])
    return top.withColumn("total_flagged", total)


def patient_list(context: DataFrame, current: DataFrame, risk: DataFrame | None = None) -> DataFrame:
    """Patient list rows: demographics, condition/medication names and
    counts, time of the last update, per-vital value / units / trend / pct (pivot
    over the six known vitals in one aggregation) the patient's risk score
    (left join), and its rank in the order of the patient ids."""
    names = [v[2] for v in rules.VITALS]
    piv = current.groupBy(KEY).pivot("vital", names).agg(
        F.first("value").alias("value"), F.first("units").alias("units"), F.first("direction").alias("trend"),
        F.first("pct_change").alias("pct"))
    out = context.select(KEY, F.col("patient_age").alias("age"), F.col("patient_gender").alias("gender"),
                         "conditions", "medications", "condition_count", "medication_count",
                         F.col("last_update").alias("last_updated")) \
        .join(piv, KEY, "left")
    if risk is not None:
        out = out.join(risk.select(KEY, "risk_level", "risk_pct", "readmit_probability"), KEY, "left")
    return global_rank(out, [KEY], [spread(context, KEY)])


def patient_list_small(context: DataFrame, n: int = 50) -> DataFrame:
    """Compact list: counts and has_vitals for the first n patients by id,
    plus the total number of patients."""
    small = context.select(KEY, F.col("patient_age").alias("age"), F.col("patient_gender").alias("gender"),
                           F.col("condition_count").alias("conditions_count"),
                           F.col("medication_count").alias("medications_count"),
                           (F.col("vital_count") > 0).alias("has_vitals"))
    total = context.agg(F.count(F.lit(1))).scalar()
    return rank_top(small, n, [F.col(KEY)]).withColumn("total_patients", total)


def source_impact(context: DataFrame) -> DataFrame:
    """Share of patients that would lose data if a source stopped, for all
    three sources in one aggregate (then unpivoted)."""
    agg = context.agg(
        F.count_if(F.col("vital_count") > 0).alias("csv"),
        F.count_if(F.col("condition_count") > 0).alias("postgres"),
        F.count_if(F.col("medication_count") > 0).alias("mysql"),
        F.count(F.lit(1)).alias("total_patients"),
    )
    meta = {"csv": rules.SOURCE_SYSTEMS[0], "postgres": rules.SOURCE_SYSTEMS[1], "mysql": rules.SOURCE_SYSTEMS[2]}
    stack = ", ".join(f"'{k}', '{m[1]}', '{m[2]}', '{m[3]}', {k}" for k, m in meta.items())
    long = agg.selectExpr(f"stack(3, {stack}) as (source, label, topic, data_type, patients_affected)",
                          "total_patients")
    return long.withColumn("impact_percentage", F.round(
        F.col("patients_affected") / F.greatest(F.col("total_patients"), F.lit(1)) * 100, 1))


# --- fixed values (our own, the reference ships no formula): action texts
ACTIONS = [
    # severity,  elevated risk, action
    ("critical", True,  "Immediate bedside review and care-team huddle"),
    ("critical", False, "Immediate bedside review"),
    ("warning",  True,  "Review vitals today and schedule transition-of-care follow-up"),
    ("warning",  False, "Review vitals today"),
    ("none",     True,  "Schedule transition-of-care follow-up"),
]


def action_queue(summary: DataFrame, risk: DataFrame, w_critical: float = 50.0, w_reason: float = 10.0,
                 max_reasons: int = 5, w_risk: float = 0.5) -> DataFrame:
    """Acute alerts merged with chronic risk (full outer join on patient):
    a patient qualifies with an alert or a HIGH/CRITICAL level; score =
    w_critical*critical + w_reason*min(reasons, max_reasons) + w_risk*risk_pct;
    ``rank`` counts from the highest (ties by patient)."""
    j = summary.join(risk.select(KEY, "risk_level", "risk_pct"), KEY, "full_outer")
    n = F.coalesce(F.col("n_reasons"), F.lit(0))
    sev = F.coalesce(F.col("severity"), F.lit("none"))
    elevated = F.coalesce(F.col("risk_level").isin("HIGH", "CRITICAL"), F.lit(False))
    score = (F.when(sev == "critical", w_critical).otherwise(0.0) + F.least(n, F.lit(max_reasons)) * w_reason
             + F.coalesce(F.col("risk_pct").cast("double"), F.lit(0.0)) * w_risk)
    action = None
    for s, e, text in ACTIONS:
        c = (sev == s) & (elevated == e)
        action = F.when(c, text) if action is None else action.when(c, text)
    queue = j.where((n > 0) | elevated).select(
        KEY, n.cast("long").alias("n_reasons"), sev.alias("severity"), "risk_level",
        F.col("risk_pct").cast("double").alias("risk_pct"), F.round(score, 2).alias("score"),
        action.alias("action")).withColumn("_less", -F.col("score"))
    cents = F.round(F.col("_less") * 100).cast("long")  # a score has two decimals, so rows of one number are ties
    return global_rank(queue, ["_less", KEY], [cents, spread(risk, KEY)]).drop("_less")
