"""Dead-letter analytics: categories, breakdowns, timeline, bursts, recency,
root-cause diagnosis, alert report and replay.

Every roll-up is a grouped partial aggregate followed by one-row
aggregates; nothing collects error lists to the driver.  ``last_n`` limits
an analysis to the newest n records (the reference's 100-entry ring) and is
off by default, so the whole dead-letter table is analysed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import rules
from wardline.functions.scalar import category
from wardline.operators.sequence import sequence_ops


def ring(dlq: DataFrame, n: int | None) -> DataFrame:
    if n is None:
        return dlq
    return dlq.orderBy(F.col("rec_offset").desc()).limit(n)


def dlq_recent(dlq: DataFrame, n: int = rules.DLQ_RING) -> DataFrame:
    """The error ring: newest n records, absent reason/source -> ``unknown``,
    other absent fields -> ''."""
    from pyspark.sql import Window
    top = ring(dlq, n)
    return top.select(
        "rec_offset",
        F.coalesce("error_reason", F.lit("unknown")).alias("error_reason"),
        F.coalesce("source_system", F.lit("unknown")).alias("source_system"),
        F.coalesce(F.date_format("failed_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("")).alias("failed_at"),
        F.coalesce("topic_intended", F.lit("")).alias("topic_intended"),
        F.row_number().over(Window.orderBy(F.col("rec_offset").desc())).cast("long").alias("rank"))


def by_category(dlq: DataFrame, trim: bool = False, last_n: int | None = None) -> DataFrame:
    """Errors per category (text before the first ':'), most frequent first.

    A reason without a colon is a category of its own, so there may be many: the
    rank is numbered bucket by bucket (count, first letter), not in one task."""
    g = ring(dlq, last_n).groupBy(category(F.coalesce("error_reason", F.lit("unknown")), trim).alias("category")) \
        .agg(F.count(F.lit(1)).alias("errors"))
    g = g.withColumns({"_all": F.lit(0), "_less": -F.col("errors")})
    ranked = sequence_ops(g, "_all", ["_less", "category"], row_number="rank",
                          bucket=F.col("_less") * 0x110000 + F.ascii("category"))
    return ranked.select("category", "errors", "rank")


def with_field(dlq: DataFrame) -> DataFrame:
    """Dead letters with the ``field`` of the row that the reason is about; null
    where the reason is not one of the validator's."""
    names = F.create_map(*[F.lit(x) for pair in rules.REASON_FIELD.items() for x in pair])
    return dlq.withColumn("field", F.try_element_at(names, category(F.coalesce("error_reason", F.lit("")), trim=True)))


def breakdown(dlq: DataFrame, last_n: int | None = None) -> DataFrame:
    """Errors by category, source, intended topic and, where records name one,
    failed field in one pass (grouping sets), long format ``(dimension, value,
    errors)``."""
    dims = {"category": category(F.coalesce("error_reason", F.lit("unknown")), trim=True),
            "source_system": F.coalesce("source_system", F.lit("unknown")),
            "topic_intended": F.coalesce("topic_intended", F.lit("unknown"))}
    if "field" in dlq.columns:
        dims["field"] = F.col("field")
    names = list(dims)
    d = ring(dlq, last_n).select(*[c.alias(n) for n, c in dims.items()])
    g = d.groupingSets([[n] for n in names], *names).agg(F.count(F.lit(1)).alias("errors"), F.grouping_id().alias("_g"))
    whole = (1 << len(names)) - 1
    dim = F.coalesce(*[F.when(F.col("_g") == whole - (1 << (len(names) - 1 - i)), n) for i, n in enumerate(names)])
    # a record without a field is in no field's count
    return g.select(dim.alias("dimension"), F.coalesce(*names).alias("value"), "errors").where("value is not null")


#: Items that the sketch of ``top_reasons`` tracks; it may miss an item that makes up
#: less than 8 in so many rows.
TRACKED = 100_000


def top_reasons(dlq: DataFrame, k: int = 10, tracked: int = TRACKED) -> DataFrame:
    """The ``k`` most frequent exact reasons with their counts and ranks (ties by
    text).  Reasons carry values, so they may be as many as the records.

    First pass: a frequent-items sketch of fixed size finds the candidates.  Second
    pass: exact counts of the candidates alone, which are few enough to broadcast.
    The sketch misses no reason that occurs more than ``8 / tracked`` of all rows, so
    the answer is exact if the last of the k does; else all reasons are counted."""
    reason = F.coalesce("error_reason", F.lit("unknown"))
    wide = min(10 * k, tracked)
    found = dlq.agg(F.expr(f"approx_top_k(coalesce(error_reason, 'unknown'), {wide}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    candidates = dlq.sparkSession.createDataFrame([(x["item"],) for x in found["top"] or []], "reason string")
    rows = dlq.select(reason.alias("reason"))
    counts = rows.join(F.broadcast(candidates), "reason", "left_semi").groupBy("reason").agg(F.count(F.lit(1)).alias("errors"))
    top = counts.orderBy(F.desc("errors"), "reason").limit(k)
    kept = top.collect()  # k rows
    beyond = 8 * (found["n"] or 0) / tracked
    complete = len(found["top"] or []) < wide and beyond < 1
    if not complete and (len(kept) < k or kept[-1]["errors"] <= beyond or (found["top"] and kept[-1]["errors"] <= min(x["count"] for x in found["top"]))):
        top = rows.groupBy("reason").agg(F.count(F.lit(1)).alias("errors")).orderBy(F.desc("errors"), "reason").limit(k)
        kept = top.collect()
    ranked = [(r["reason"], r["errors"], i + 1) for i, r in enumerate(kept)]
    return dlq.sparkSession.createDataFrame(ranked, "reason string, errors long, rank long")


def timeline(dlq: DataFrame, last_n: int | None = None) -> DataFrame:
    """Errors per hour (first 13 characters of the ISO failure time)."""
    return ring(dlq, last_n).where(F.col("failed_at").isNotNull()) \
        .groupBy(F.date_format("failed_at", "yyyy-MM-dd'T'HH").alias("hour")) \
        .agg(F.count(F.lit(1)).alias("errors"))


def burst(dlq: DataFrame, last_n: int | None = None) -> DataFrame:
    """Burst flag: the busiest hour holds more than half of all errors."""
    t = timeline(dlq, last_n)
    total = ring(dlq, last_n).agg(F.count(F.lit(1))).scalar()
    return t.agg(F.max("errors").alias("max_hour_errors")).select(
        total.alias("total_errors"), F.coalesce("max_hour_errors", F.lit(0)).alias("max_hour_errors"),
        F.coalesce(F.col("max_hour_errors") > total * 0.5, F.lit(False)).alias("is_burst"))


def recency(dlq: DataFrame, as_of: str, last_n: int | None = None) -> DataFrame:
    """Errors younger than 5 min / 1 h / older at ``as_of`` (a missing time
    counts as older); severity CRITICAL > 10 recent, WARNING > 0, else INFO."""
    age = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp("failed_at")
    g = ring(dlq, last_n).agg(
        F.count(F.lit(1)).alias("total_errors"),
        F.count_if(age < 300).alias("last_5_minutes"),
        F.count_if((age >= 300) & (age < 3600)).alias("last_1_hour"),
        F.count_if(age.isNull() | (age >= 3600)).alias("older"))
    return g.select(
        F.when(F.col("total_errors") > 0, "ERRORS_FOUND").otherwise("CLEAN").alias("status"),
        "total_errors", "last_5_minutes", "last_1_hour", "older",
        F.when(F.col("last_5_minutes") > 10, "CRITICAL").when(F.col("last_5_minutes") > 0, "WARNING")
        .otherwise("INFO").alias("severity"))


def cause(reason: Column) -> Column:
    """The class of a reason: the first whose keywords occur in it."""
    low = F.lower(reason)
    found = [F.when(F.greatest(*[low.contains(w) for w in (*words, *words[:1])]), name) for name, words, _ in rules.ROOT_CAUSES]
    return F.coalesce(*found, F.lit("unknown"))


def root_cause(reason: Column) -> Column:
    texts = {name: text for name, _, text in rules.ROOT_CAUSES} | {"unknown": rules.ROOT_CAUSE_UNKNOWN}
    return F.create_map(*[F.lit(x) for pair in texts.items() for x in pair])[cause(reason)]


def diagnosis(dlq: DataFrame, last_n: int | None = None) -> DataFrame:
    """Most common exact reason (ties: the one seen first), its count and
    share, and the keyword-classified root cause."""
    r = ring(dlq, last_n)
    per = r.groupBy(F.coalesce("error_reason", F.lit("unknown")).alias("reason")) \
        .agg(F.count(F.lit(1)).alias("n"), F.min("rec_offset").alias("first"))
    total = r.agg(F.count(F.lit(1))).scalar()
    top = per.agg(F.max_by(F.struct("reason", "n"), F.struct(F.col("n"), (-F.col("first")).alias("f"))).alias("t"))
    return top.select(F.col("t.reason").alias("most_common_error"), F.col("t.n").alias("occurrence_count"),
                      F.round(F.col("t.n") / total * 100, 1).alias("percentage"),
                      root_cause(F.col("t.reason")).alias("root_cause"))


def advice(spark) -> DataFrame:
    """``(cause, part, step, text)``: what the classes of root causes advise, one row
    for each sentence (a fixed table of some twenty rows)."""
    rows = []
    for name, (likely, fixes, again) in rules.ROOT_CAUSE_ADVICE.items():
        rows += [(name, "likely_reason", 0, likely)] if likely else []
        rows += [(name, "fix", i + 1, text) for i, text in enumerate(fixes)]
        rows += [(name, "reprocess", 0, again)] if again else []
    return spark.createDataFrame(rows, "cause string, part string, step int, text string")


def diagnosis_advice(dlq: DataFrame, last_n: int | None = None) -> DataFrame:
    """What to do about the most common reason: ``(most_common_error, root_cause,
    part, step, text)``, one row for each sentence, fixes numbered from 1.  An
    empty log gives no rows."""
    top = diagnosis(dlq, last_n).where("most_common_error is not null")
    told = top.select("most_common_error", "root_cause", cause(F.col("most_common_error")).alias("cause"))
    return told.join(F.broadcast(advice(dlq.sparkSession)), "cause").select("most_common_error", "root_cause", "part", "step", "text")


def alert_level(dlq: DataFrame, components: DataFrame) -> DataFrame:
    """OK / WARNING (any error) / CRITICAL (more than 20 errors or a
    component not RUNNING)."""
    n = dlq.agg(F.count(F.lit(1))).scalar()
    failed = components.agg(F.count_if(F.col("state") != "RUNNING")).scalar()
    one = components.agg(F.count(F.lit(1)).alias("components"))
    level = F.when((n > 20) | (failed > 0), "CRITICAL").when(n > 0, "WARNING").otherwise("OK")
    return one.select(n.alias("dlq_count"), failed.alias("failed_connectors"), level.alias("level"))


def alert_report(dlq: DataFrame, components: DataFrame, sources: DataFrame) -> DataFrame:
    """Priority LOW -> MEDIUM (errors) -> HIGH (> 20) -> CRITICAL (a
    component not RUNNING) with the list of recommended actions; with no
    action the report says all systems are normal and priority is LOW."""
    n = dlq.agg(F.count(F.lit(1))).scalar()
    failed = components.where(F.col("state") != "RUNNING") \
        .select(F.concat(F.lit("Connector '"), F.col("component"), F.lit("' is "), F.col("state"),
                         F.lit(". Restart or check logs.")).alias("a"), F.col("component").alias("o"))
    bad_src = sources.where(F.col("status") != "healthy") \
        .select(F.concat(F.lit("Source '"), F.col("source_system"), F.lit("' is "), F.col("status"),
                         F.lit(". Check data flow.")).alias("a"), F.col("source_system").alias("o"))
    failed_actions = failed.agg(F.array_sort(F.collect_list(F.struct("o", "a"))).alias("l")).select(
        F.transform("l", lambda x: x.getField("a")).alias("l")).select("l").scalar()
    src_actions = bad_src.agg(F.array_sort(F.collect_list(F.struct("o", "a"))).alias("l")).select(
        F.transform("l", lambda x: x.getField("a")).alias("l")).select("l").scalar()
    n_failed = components.agg(F.count_if(F.col("state") != "RUNNING")).scalar()
    n_bad_src = sources.agg(F.count_if(F.col("status") != "healthy")).scalar()
    dlq_action = F.when(n > 0, F.array(F.concat(F.lit("DLQ has "), n.cast("string"),
                                                F.lit(" errors. Run diagnose_root_cause for detailed analysis."))))\
        .otherwise(F.array().cast("array<string>"))
    actions = F.concat(dlq_action, F.coalesce(failed_actions, F.array().cast("array<string>")),
                       F.coalesce(src_actions, F.array().cast("array<string>")))
    pr = F.when(n_failed > 0, "CRITICAL").when(n > 20, "HIGH").when(n > 0, "MEDIUM").otherwise("LOW")
    one = components.agg(F.count(F.lit(1)).alias("connectors_total"))
    out = one.select(n.alias("dlq_errors"), "connectors_total", n_failed.alias("connectors_failed"),
                     n_bad_src.alias("sources_alerting"), actions.alias("_a"), pr.alias("_p"))
    none = F.size("_a") == 0
    return out.select(
        "dlq_errors", "connectors_total", "connectors_failed", "sources_alerting",
        F.when(none, "LOW").otherwise(F.col("_p")).alias("priority"),
        F.when(none, 1).otherwise(F.size("_a")).cast("long").alias("actions_needed"),
        F.to_json(F.when(none, F.array(F.lit("All systems operating normally. No action needed.")))
                  .otherwise(F.col("_a"))).alias("recommended_actions"))


def replay(dlq: DataFrame, patients: DataFrame, fix=None) -> DataFrame:
    """Replay dead letters: decode the original row, apply ``fix`` (a
    DataFrame -> DataFrame repair), validate again and route anew."""
    from pyspark.sql import types as T
    from wardline.operators import ingest
    fields = ["PATIENT", "ENCOUNTER", "DATE", "CODE", "DESCRIPTION", "VALUE", "UNITS"]
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    rows = dlq.select("rec_offset", F.from_json("original_data", schema).alias("_o")).select("rec_offset", "_o.*")
    rows = (fix or default_fix)(rows)
    c = ingest.classify_observations(rows, patients)
    return c.select("rec_offset", "PATIENT", "CODE", "VALUE", "error_reason",
                    F.when(F.col("is_valid"), "valid").otherwise("dlq").alias("route"))


def default_fix(rows: DataFrame) -> DataFrame:
    """Typical repairs: decimal comma -> point, and body temperature sent in
    Celsius (25..45) converted to Fahrenheit."""
    v = F.regexp_replace(F.trim("VALUE"), ",", ".")
    num = v.try_cast("double")
    celsius = (F.col("CODE") == "8310-5") & num.between(25, 45)
    fixed = F.when(celsius, F.format_number(num * 9 / 5 + 32, 2)).otherwise(v)
    return rows.withColumn("VALUE", F.regexp_replace(fixed, ",", ""))
