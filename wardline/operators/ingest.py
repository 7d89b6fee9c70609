"""Vital-sign ingestion: filter, validate, dead-letter split, enrich.

One left join against the de-duplicated patient dimension serves both the
"known patient" check and the enrichment, so the whole validator is a single
join plus projections.  The join strategy is left to Catalyst/AQE: the
dimension is broadcast only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold``; otherwise both sides shuffle on
the patient key (AQE splits a hot patient's partition).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline import rules
from wardline.functions.scalar import age_years, parse_birthdate, parse_iso_date, py_float, py_repr, py_strip


def patients_dim(patients: DataFrame, order_col: str | None = None) -> DataFrame:
    """Demographics keyed by ``Id``; the last row of a duplicated Id wins.

    "Last" is ``order_col`` when given, else the greatest (file name, position in
    the file): Spark packs files into tasks by size, so a running id alone does
    not follow their order.  ``max_by`` is a partial aggregate, so duplicates are
    folded map-side before the shuffle.
    As the static side of a stream-static join, materialise the result once
    (``.checkpoint()`` into ``spark.checkpoint.dir``).
    """
    order = F.col(order_col) if order_col else F.struct(
        F.input_file_name(), F.input_file_block_start(), F.monotonically_increasing_id())
    cols = [c for c in patients.columns if c != "Id"]
    agg = patients.withColumn("_ord", order).groupBy("Id").agg(
        F.max_by(F.struct(*cols), F.col("_ord")).alias("_r"))
    return agg.select("Id", *[F.col(f"_r.{c}").alias(c) for c in cols])


def vitals_only(obs: DataFrame, code_col: str = "CODE") -> DataFrame:
    """Keep the six vital-sign LOINC codes (pushed to the scan as a filter
    where the code is a stored column)."""
    return obs.where(F.col(code_col).isin(rules.VITAL_CODES))


def _range_bounds():
    lo = F.create_map(*[x for code, (a, _) in rules.VALID_RANGE.items() for x in (F.lit(code), F.lit(a))])
    hi = F.create_map(*[x for code, (_, b) in rules.VALID_RANGE.items() for x in (F.lit(code), F.lit(b))])
    return lo, hi


def _reason(template: str, **parts: Column) -> Column:
    """A reason text with its ``{names}`` filled in."""
    pieces = re.split(r"\{(\w+)\}", template)
    return F.concat(*[parts[x] if i % 2 else F.lit(x) for i, x in enumerate(pieces) if i % 2 or x])


def classify_observations(obs: DataFrame, patients: DataFrame) -> DataFrame:
    """Adds ``is_vital``, ``error_reason`` (null = valid), ``num_value`` and the
    patient's ``_birthdate`` / ``_gender`` to every observation row.

    Checks run in the reference order; the first failing one names the
    reason: empty value, unparseable value, out of range (NaN passes, bounds
    inclusive), unknown patient, empty date.
    """
    dim = patients.select(F.col("Id").alias("_pid"), F.col("BIRTHDATE").alias("_birthdate"),
                          F.col("GENDER").alias("_gender"))
    lo_m, hi_m = _range_bounds()
    # Staged columns: each heavy expression is computed once and referenced
    # by name, which keeps the generated code of the stage small.
    j = (obs.join(dim, obs["PATIENT"] == dim["_pid"], "left")
         .withColumn("is_vital", F.col("CODE").isin(rules.VITAL_CODES))
         .withColumn("_s", py_strip(F.col("VALUE")))
         .withColumn("num_value", py_float(F.col("_s")))
         .withColumn("_lo", F.element_at(lo_m, F.col("CODE")))
         .withColumn("_hi", F.element_at(hi_m, F.col("CODE"))))
    num, s, lo, hi = F.col("num_value"), F.col("_s"), F.col("_lo"), F.col("_hi")
    out_of_range = lo.isNotNull() & ~F.isnan(num) & ((num < lo) | (num > hi))
    reason = (
        F.when(~F.col("is_vital"), F.lit(None).cast("string"))
        .when(s == "", F.lit(rules.REASON_MISSING_VALUE))
        .when(num.isNull(), _reason(rules.REASON_INVALID_VALUE, value=s))
        .when(out_of_range, _reason(rules.REASON_OUT_OF_RANGE, code=F.col("CODE"), value=py_repr(num), lo=lo.cast("string"), hi=hi.cast("string")))
        .when(F.col("_pid").isNull(), _reason(rules.REASON_UNKNOWN_PATIENT, id8=F.substring(F.coalesce("PATIENT", F.lit("")), 1, 8)))
        .when(F.coalesce(F.col("DATE"), F.lit("")) == "", F.lit(rules.REASON_MISSING_DATE))
    )
    ok = (F.col("is_vital") & (s != "") & num.isNotNull() & ~F.coalesce(out_of_range, F.lit(False))
          & F.col("_pid").isNotNull() & (F.coalesce(F.col("DATE"), F.lit("")) != ""))
    return j.select(*obs.columns, "is_vital", ok.alias("is_valid"), reason.alias("error_reason"), "num_value",
                    "_birthdate", "_gender")


def validate_vitals(obs: DataFrame, patients: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) branches of the vital-sign rows."""
    c = classify_observations(obs, patients)
    return c.where("is_valid"), c.where(F.col("is_vital") & ~F.col("is_valid"))


def enrich_vitals(valid: DataFrame) -> DataFrame:
    """The 10-field vital record (+ ``rec_offset`` / ``ingest_ts`` carried for
    arrival order and record time)."""
    extra = [c for c in ("rec_offset", "ingest_ts") if c in valid.columns]
    valid = (valid.withColumn("_bd", parse_birthdate(F.col("_birthdate")))
             .withColumn("_rd", parse_iso_date(F.col("DATE"))))
    return valid.select(
        F.col("PATIENT").alias("patient_id"),
        F.col("ENCOUNTER").alias("encounter_id"),
        F.col("DATE").alias("timestamp"),
        F.col("CODE").alias("vital_type"),
        F.col("DESCRIPTION").alias("vital_description"),
        F.col("num_value").alias("value"),
        F.coalesce(F.col("UNITS"), F.lit("")).alias("units"),
        age_years(F.col("_bd"), F.col("_rd")).alias("patient_age"),
        F.col("_gender").alias("patient_gender"),
        F.lit(rules.PRODUCER_SOURCE).alias("source_system"),
        *extra,
    )


def process_vitals(obs: DataFrame, patients: DataFrame) -> DataFrame:
    """observations -> enriched valid vitals (filter, validate, join, project)."""
    valid, _ = validate_vitals(obs, patients_dim(patients))
    return enrich_vitals(valid)


def unknown_patients(obs: DataFrame, patients: DataFrame) -> DataFrame:
    """Vital rows whose patient has no demographics row (anti join)."""
    dim = patients.select(F.col("Id").alias("PATIENT")).distinct()
    return vitals_only(obs).join(dim, "PATIENT", "left_anti")


def dlq_records(rejected: DataFrame, failed_at_col: str = "ingest_ts",
                topic: str = rules.VITALS_TOPIC) -> DataFrame:
    """Dead-letter records: original row as JSON text plus reason and origin."""
    orig = ["PATIENT", "ENCOUNTER", "DATE", "CODE", "DESCRIPTION", "VALUE", "UNITS"]
    failed = F.col(failed_at_col) if failed_at_col in rejected.columns else F.current_timestamp()
    src = F.col("source_system") if "source_system" in rejected.columns else F.lit(rules.PRODUCER_SOURCE)
    return rejected.select(
        F.col("rec_offset"),
        F.to_json(F.struct(*[F.col(c) for c in orig if c in rejected.columns])).alias("original_data"),
        F.col("error_reason"),
        src.alias("source_system"),
        failed.alias("failed_at"),
        F.lit(topic).alias("topic_intended"),
    )


COUNTERS = ("total", "vitals", "produced", "skipped_non_vital", "sent_to_dlq", "errors")


def counters() -> list[Column]:
    """The producer's counters over classified rows, as aggregates."""
    is_vital, is_valid = F.col("is_vital"), F.col("is_valid")
    found = (F.count(F.lit(1)), F.count_if(is_vital), F.count_if(is_valid), F.count_if(~is_vital), F.count_if(is_vital & ~is_valid), F.count_if(F.lit(False)))
    return [c.alias(n) for c, n in zip(found, COUNTERS, strict=True)]


def ingest_stats(classified: DataFrame) -> DataFrame:
    """Producer counters in one global aggregate (partial per task)."""
    return classified.agg(*counters())


def first_n(df: DataFrame, n: int, order_col: str = "rec_offset") -> DataFrame:
    """``max_records``: the first n produced rows in arrival order, with rank.

    ``orderBy().limit()`` becomes TakeOrderedAndProject (a per-task top-n then
    one merge of n rows); the rank is assigned only to those n rows.
    """
    top = df.orderBy(order_col).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(order_col)).cast("long"))


def ingest_keyed(df: DataFrame, key_field: str = "patient_id") -> DataFrame:
    """Generic keyed ingestion: a missing/empty key routes the row to the DLQ.

    Adds ``key`` (default ``unknown``) and ``route`` (``topic`` / ``dlq``).
    """
    key = F.coalesce(F.col(key_field).cast("string"), F.lit("unknown"))
    bad = (key == "") | (key == "unknown")
    return df.withColumn("key", key).withColumn("route", F.when(bad, "dlq").otherwise("topic"))
