"""Continuously-updated tables and derived streams over the vital/condition/
medication streams.  Each function works on a static DataFrame (the final
table) and on a streaming one (run it with ``outputMode("update")`` for the
aggregates and ``append`` for the derived streams, see ``wardline.streaming``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import rules


def collect_per_key(log: DataFrame, key: str, cols: list[str], order_col: str, ts_col: str,
                    count_name: str, last_name: str = "last_updated",
                    list_names: list[str] | None = None) -> DataFrame:
    """COLLECT_LIST per key in arrival order, COUNT(*), MAX(ts) (array form,
    for keys whose message count is bounded; see ``list_rows_per_key`` for
    the long form used at scale).

    Every message counts, so repeats stay.  Order is made explicit by sorting
    ``(order_col, value)`` structs; ``collect_list`` is a partial aggregate, so
    each task folds its share of a hot key before the shuffle.
    """
    list_names = list_names or [f"{c}s" for c in cols]
    agg = log.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), *[F.col(c) for c in cols]))).alias("_l"),
        F.count(F.lit(1)).alias(count_name),
        F.max(ts_col).alias(last_name),
    )
    return agg.select(key, *[_field_of("_l", c).alias(n) for c, n in zip(cols, list_names)],
                      count_name, last_name)


def _field_of(arr: str, field: str) -> Column:
    return F.transform(arr, lambda x: x.getField(field))


def list_rows_per_key(log: DataFrame, key: str, cols: list[str], order_col: str, ts_col: str,
                      count_name: str, last_name: str = "last_updated") -> DataFrame:
    """The per-key list table in long form: every message row with its list
    position (``order_col``) plus the key's COUNT(*) and MAX(ts).

    Nothing is collected: the per-key figures are partial aggregates joined
    back to the rows (AQE broadcasts the aggregate when it is small and
    splits a hot key's partition otherwise), so a key holding a third of all
    messages is never gathered into one task or one row.
    """
    return log.select(key, order_col, *cols).join(per_key(log, key, ts_col, count_name, last_name), key)


def per_key(log: DataFrame, key: str, ts_col: str, count_name: str, last_name: str = "last_updated") -> DataFrame:
    """One row per key: COUNT(*) and MAX(ts).  The list itself is the long form
    of ``list_rows_per_key``, so no key's messages meet in one row."""
    return log.groupBy(key).agg(F.count(F.lit(1)).alias(count_name), F.max(ts_col).alias(last_name))


def conditions_rows(conditions: DataFrame) -> DataFrame:
    return list_rows_per_key(conditions, "patient_id", ["condition_name", "severity"], "rec_offset", "updated_at",
                             "condition_count")


def medications_rows(medications: DataFrame) -> DataFrame:
    return list_rows_per_key(medications, "patient_id", ["medication_name", "dosage"], "rec_offset", "updated_at",
                             "medication_count")


def conditions_latest(conditions: DataFrame) -> DataFrame:
    return collect_per_key(conditions, "patient_id", ["condition_name", "severity"], "rec_offset", "updated_at",
                           "condition_count", list_names=["conditions", "severities"])


def medications_latest(medications: DataFrame) -> DataFrame:
    return collect_per_key(medications, "patient_id", ["medication_name", "dosage"], "rec_offset", "updated_at",
                           "medication_count", list_names=["medications", "dosages"])


def _latest_by_offset(value: str, order: str, fn: str) -> Column:
    # LATEST_BY_OFFSET / EARLIEST_BY_OFFSET ignore null values.
    return F.expr(f"{fn}({value}, {order}) FILTER (WHERE {value} IS NOT NULL)")


def window_stats(vitals: DataFrame, time_col: str = "ingest_ts", size: str = "1 hour",
                 keys: tuple[str, ...] = ("patient_id", "vital_type"), value_col: str = "value",
                 offset_col: str = "rec_offset") -> DataFrame:
    """Tumbling-window statistics per key: count, avg, min, max, latest and
    earliest value by offset.  Window bounds as epoch milliseconds."""
    g = vitals.groupBy(*keys, F.window(time_col, size).alias("w")).agg(
        F.count(F.lit(1)).alias("reading_count"),
        F.avg(value_col).alias("avg_value"),
        F.min(value_col).alias("min_value"),
        F.max(value_col).alias("max_value"),
        _latest_by_offset(value_col, offset_col, "max_by").alias("latest_value"),
        _latest_by_offset(value_col, offset_col, "min_by").alias("earliest_value"),
    )
    return g.select(*keys, F.unix_millis(F.col("w.start")).alias("window_start"),
                    F.unix_millis(F.col("w.end")).alias("window_end"),
                    "reading_count", "avg_value", "min_value", "max_value", "latest_value", "earliest_value")


def window_count(df: DataFrame, time_col: str = "ingest_ts", size: str = "1 minute",
                 keys: tuple[str, ...] = ("source_system",)) -> DataFrame:
    """Messages per key per tumbling window (map-side partial counts)."""
    g = df.groupBy(*keys, F.window(time_col, size).alias("w")).agg(F.count(F.lit(1)).alias("message_count"))
    return g.select(*keys, F.unix_millis(F.col("w.start")).alias("window_start"), "message_count")


def integration_health(vitals: DataFrame) -> DataFrame:
    """Per-record data-quality status (stateless derived stream)."""
    v = F.col("value")
    status = F.when(v.isNull(), "NULL_VALUE").when(v < 0, "NEGATIVE_VALUE").otherwise("VALID")
    cols = ["source_system", "vital_type", status.alias("quality_status"), "value",
            F.col("timestamp").alias("event_time")]
    if "rec_offset" in vitals.columns:
        cols.append("rec_offset")
    return vitals.select(*cols)


def _rule_cond(code: str, op: str, thr: float) -> Column:
    v = F.col("value")
    cmp = (v > thr) if op == ">" else (v < thr)
    # NaN compares false both ways in the reference engines; Spark orders NaN
    # above every number, so it is excluded explicitly.
    return (F.col("vital_type") == code) & ~F.isnan(v) & cmp


def vital_anomalies(vitals: DataFrame, anomaly_rules=None) -> DataFrame:
    """Clinically abnormal readings: OR of the rules as a filter, the first
    matching rule names the anomaly.  Stateless, so it streams in append mode
    and codegens into the scan stage."""
    anomaly_rules = anomaly_rules or rules.ANOMALY_RULES
    conds = [(_rule_cond(c, op, t), name) for c, op, t, name in anomaly_rules]
    any_rule = conds[0][0]
    for c, _ in conds[1:]:
        any_rule = any_rule | c
    kind = None
    for c, name in conds:
        kind = F.when(c, name) if kind is None else kind.when(c, name)
    kind = kind.otherwise("UNKNOWN")
    cols = ["patient_id", "patient_age", "patient_gender", "vital_type", "vital_description", "value", "units",
            F.col("timestamp").alias("event_time"), kind.alias("anomaly_type"),
            F.lit(rules.PRODUCER_SOURCE).alias("source_system")]
    if "rec_offset" in vitals.columns:
        cols.append("rec_offset")
    return vitals.where(any_rule).select(*cols)
