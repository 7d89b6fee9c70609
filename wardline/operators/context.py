"""Per-patient context: the fold of the vital, condition and medication
streams into one expiring record per patient.

Arrival order is the explicit ``rec_offset`` column everywhere, never the
physical row order.  Every per-key fold is a partial aggregate (``max_by``,
``min``, ``count``), so a patient holding a large share of the rows is folded
inside each map task before the shuffle; the "last n readings" frame uses
``row_number() <= n``, which Catalyst plans with a map-side
``WindowGroupLimit`` so at most n rows per key and task reach the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline import rules

KEY = "patient_id"


def vital_readings(vitals: DataFrame) -> DataFrame:
    """Vital rows with their context key (``heart_rate`` ...); unmapped codes
    are dropped."""
    m = F.create_map(*[x for code, key in rules.VITAL_KEY.items() for x in (F.lit(code), F.lit(key))])
    return vitals.withColumn("vital", F.element_at(m, F.col("vital_type"))).where(F.col("vital").isNotNull())


def latest_vitals(readings: DataFrame, keys: tuple[str, ...] = (KEY,)) -> DataFrame:
    """Current value per patient x vital = the last arrived reading (not the
    greatest timestamp)."""
    last = F.max_by(F.struct("value", "units", "timestamp", "rec_offset"), F.col("rec_offset"))
    g = readings.groupBy(*keys, "vital").agg(last.alias("_l"))
    return g.select(*keys, "vital", "_l.value", "_l.units", "_l.timestamp", "_l.rec_offset")


def vitals_history(readings: DataFrame, n: int = rules.HISTORY_LEN, keys: tuple[str, ...] = (KEY,)) -> DataFrame:
    """The newest ``n`` readings per patient x vital (``rn`` 1 = newest)."""
    w = Window.partitionBy(*keys, "vital").orderBy(F.col("rec_offset").desc())
    return (readings.select(*keys, "vital", "rec_offset", "value", "timestamp")
            .withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n))


def trend_of(first: Column, last: Column) -> dict[str, Column]:
    """``direction``, ``change`` and ``pct_change`` from the oldest to the newest
    reading: pct relative to the oldest (0 when it is 0), direction by sign.  NaN
    readings give a NaN change and direction ``stable``, as in Python."""
    change = last - first
    direction = (F.when(F.isnan(change), "stable").when(change > 0, "rising")
                 .when(change < 0, "falling").otherwise("stable"))
    pct = F.when(first != 0, change / first * 100).otherwise(F.lit(0.0))
    return {"direction": direction, "change": F.round(change, 2), "pct_change": F.round(pct, 2)}


def vital_trends(history: DataFrame, keys: tuple[str, ...] = (KEY,)) -> DataFrame:
    """Trend over the kept readings (``trend_of``); only with >= 2 readings."""
    g = history.groupBy(*keys, "vital").agg(
        F.count(F.lit(1)).alias("readings"),
        F.min_by("value", "rec_offset").alias("_first"),
        F.max_by("value", "rec_offset").alias("_last"),
    ).where(F.col("readings") >= 2)
    trend = trend_of(F.col("_first"), F.col("_last"))
    return g.select(*keys, "vital", *[c.alias(name) for name, c in trend.items()], "readings")


def current_vitals(readings: DataFrame, n: int = rules.HISTORY_LEN) -> DataFrame:
    """Latest value with its trend (direction ``stable`` / pct 0 when there
    is no trend yet).  Both sides are aggregated by (patient, vital), so the
    join reuses their partitioning."""
    lv = latest_vitals(readings)
    tr = vital_trends(vitals_history(readings, n))
    return (lv.join(tr, [KEY, "vital"], "left")
            .withColumn("has_trend", F.col("direction").isNotNull())
            .withColumn("direction", F.coalesce("direction", F.lit("stable")))
            .withColumn("pct_change", F.coalesce("pct_change", F.lit(0.0))))


def upsert_list(log: DataFrame, name_col: str, entry_cols: list[str], key: str = KEY,
                offset_col: str = "rec_offset", op_col: str | None = None,
                apply_deletes: bool = False) -> DataFrame:
    """Upsert-by-name list per key: the newest message per (key, name) wins,
    the list position is that of the first write (``first_offset``).

    With ``apply_deletes`` a delete (``op = 'd'``) removes the entry; a later
    write re-adds it at the end of the list.  Messages without a key are
    dropped.
    """
    log = log.where(F.coalesce(F.col(key), F.lit("")) != "")
    latest = F.max_by(F.struct(*[F.col(c) for c in entry_cols]), F.col(offset_col))
    aggs = [latest.alias("_e"), F.min(offset_col).alias("first_offset"),
            F.max(offset_col).alias("last_offset")]
    if apply_deletes and op_col:
        aggs += [F.max(F.when(F.col(op_col) == "d", F.col(offset_col))).alias("_del"),
                 F.max_by(F.col(op_col), F.col(offset_col)).alias("_op")]
    g = log.groupBy(key, F.col(name_col).alias("name")).agg(*aggs)
    if apply_deletes and op_col:
        # position after a delete = first write after the last delete; found
        # with a second partial aggregate over the rows past the delete mark
        marks = g.where(F.col("_op") != "d").select(key, "name", "_e", "last_offset", "_del")
        after = (log.select(key, F.col(name_col).alias("name"), F.col(offset_col).alias("_o"))
                 .join(marks.select(key, "name", "_del"), [key, "name"])
                 .where(F.col("_del").isNull() | (F.col("_o") > F.col("_del")))
                 .groupBy(key, "name").agg(F.min("_o").alias("first_offset")))
        g = marks.join(after, [key, "name"])
    return g.select(key, "name", *[F.col(f"_e.{c}").alias(c) for c in entry_cols], "first_offset", "last_offset")


def latest_conditions(conditions: DataFrame) -> DataFrame:
    return upsert_list(conditions, "condition_name", ["condition_code", "status", "severity"])


def latest_medications(medications: DataFrame, apply_deletes: bool = False) -> DataFrame:
    return upsert_list(medications, "medication_name", ["dosage", "frequency", "route", "status"],
                       op_col="op", apply_deletes=apply_deletes)


def _names_in_order(entries: DataFrame, alias: str) -> DataFrame:
    """Per patient: count and names ordered by list position."""
    return entries.groupBy(KEY).agg(
        F.count(F.lit(1)).alias(f"{alias}_count"),
        F.transform(F.array_sort(F.collect_list(F.struct("first_offset", "name"))),
                    lambda x: x.getField("name")).alias(alias),
    )


def patient_context(readings: DataFrame, conditions: DataFrame, medications: DataFrame) -> DataFrame:
    """One row per patient from any of the three sources (full outer merge);
    missing parts default to 0 / '' / empty.  Age and gender come from the
    newest vital.  The three inputs are each aggregated by patient, so the
    two outer joins run on already hash-partitioned children."""
    v = readings.groupBy(KEY).agg(
        F.max_by("patient_age", "rec_offset").alias("patient_age"),
        F.max_by("patient_gender", "rec_offset").alias("patient_gender"),
        F.count_distinct("vital").alias("vital_count"),
        F.count(F.lit(1)).alias("vital_readings"),
    )
    c = _names_in_order(latest_conditions(conditions), "conditions")
    m = _names_in_order(latest_medications(medications), "medications")
    j = v.join(c, KEY, "full_outer").join(m, KEY, "full_outer")
    empty = F.array().cast("array<string>")
    return j.select(
        KEY,
        F.coalesce("patient_age", F.lit(0)).alias("patient_age"),
        F.coalesce("patient_gender", F.lit("")).alias("patient_gender"),
        F.coalesce("vital_count", F.lit(0)).cast("long").alias("vital_count"),
        F.coalesce("vital_readings", F.lit(0)).cast("long").alias("vital_readings"),
        F.coalesce("conditions_count", F.lit(0)).cast("long").alias("condition_count"),
        F.coalesce("medications_count", F.lit(0)).cast("long").alias("medication_count"),
        F.coalesce("conditions", empty).alias("conditions"),
        F.coalesce("medications", empty).alias("medications"),
    )


def context_document(readings: DataFrame, conditions: DataFrame, medications: DataFrame,
                     n: int = rules.HISTORY_LEN) -> DataFrame:
    """The nested per-patient document: vitals map (value, units, timestamp,
    trend), bounded history map, condition and medication lists."""
    cur = current_vitals(readings, n)
    trend = F.when(F.col("has_trend"), F.struct("direction", "change", "pct_change", "readings"))
    vit = cur.groupBy(KEY).agg(F.map_from_entries(F.collect_list(F.struct(
        "vital", F.struct("value", "units", "timestamp", trend.alias("trend"))))).alias("vitals"))
    hist = vitals_history(readings, n).groupBy(KEY, "vital").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rec_offset", "value", "timestamp"))),
                    lambda x: F.struct(x.getField("value").alias("value"),
                                       x.getField("timestamp").alias("timestamp"))).alias("h"))
    hist = hist.groupBy(KEY).agg(F.map_from_entries(F.collect_list(F.struct(
        F.concat("vital", F.lit("_history")), "h"))).alias("vitals_history"))

    def entries(df: DataFrame, cols: list[str], alias: str) -> DataFrame:
        return df.groupBy(KEY).agg(F.transform(
            F.array_sort(F.collect_list(F.struct("first_offset", "name", *cols))),
            lambda x: F.struct(x.getField("name").alias("name"), *[x.getField(c).alias(c) for c in cols])
        ).alias(alias))

    cond = entries(latest_conditions(conditions).withColumnRenamed("condition_code", "code"),
                   ["code", "status", "severity"], "conditions")
    med = entries(latest_medications(medications), ["dosage", "frequency", "route", "status"], "medications")
    base = patient_context(readings, conditions, medications).select(KEY, "patient_age", "patient_gender")
    return (base.join(vit, KEY, "left").join(hist, KEY, "left").join(cond, KEY, "left").join(med, KEY, "left"))


def context_updates(readings: DataFrame, conditions: DataFrame, medications: DataFrame) -> DataFrame:
    """``(patient_id, t, src, rec_offset)``: everything that refreshes a context
    document, from any of the three sources; rows without a patient or a time
    refresh nothing."""
    def of(df: DataFrame, time_col: str, src: int) -> DataFrame:
        return df.select(KEY, F.col(time_col).alias("t"), F.lit(src).alias("src"), F.col("rec_offset").cast("long").alias("rec_offset"))
    return (of(readings, "ingest_ts", 0).unionByName(of(conditions, "updated_at", 1)).unionByName(of(medications, "updated_at", 2))
            .where((F.coalesce(KEY, F.lit("")) != "") & F.col("t").isNotNull()))


def _stretches(updates: DataFrame) -> DataFrame:
    """Each patient's updates by the hour: first and last time, count.  Updates of one
    hour are never parted by a gap of a day, so episodes can be told from these few
    rows; a very active patient's updates are folded in each task."""
    hour = F.floor(F.unix_micros("t") / 3_600_000_000)
    return updates.groupBy(KEY, hour.alias("hour")).agg(F.min("t").alias("lo"), F.max("t").alias("hi"), F.count(F.lit(1)).alias("updates"))


def _sessions(updates: DataFrame, ttl_seconds: int) -> DataFrame:
    """``(patient_id, started_at, last_update, updates)`` of each episode: session
    windows over the hours, each as long as its updates and the time to live.  Spark
    joins windows that touch, so an update exactly ``ttl_seconds`` after the last one
    still belongs to it."""
    length = F.make_interval(secs=((F.unix_micros("hi") - F.unix_micros("lo") + F.lit(ttl_seconds * 1_000_000)) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)"))
    return (_stretches(updates).groupBy(KEY, F.session_window("lo", length).alias("_w"))
            .agg(F.min("lo").alias("started_at"), F.max("hi").alias("last_update"), F.sum("updates").alias("updates")).drop("_w"))


def context_episodes(updates: DataFrame, ttl_seconds: int = rules.CONTEXT_TTL_SECONDS) -> DataFrame:
    """TTL episodes of ``context_updates``: a gap of more than ``ttl_seconds``
    without any update expires the document, and the next message starts a fresh
    one.  Episodes are numbered in order; a patient has at most one for each gap, so
    the numbering window stays small however many updates there are."""
    numbered = F.row_number().over(Window.partitionBy(KEY).orderBy("started_at")).cast("long")
    return _sessions(updates, ttl_seconds).select(
        KEY, numbered.alias("episode"), "started_at", "last_update", "updates",
        (F.col("last_update") + F.make_dt_interval(secs=F.lit(ttl_seconds))).alias("expires_at"))


def newest_episode(episodes: DataFrame) -> DataFrame:
    """Each patient's newest episode, alive or not."""
    newest = episodes.groupBy(KEY).agg(F.max_by(F.struct("episode", "started_at", "last_update", "updates",
                                                         "expires_at"), F.col("episode")).alias("_e"))
    return newest.select(KEY, "_e.*")


def document_starts(updates: DataFrame, ttl_seconds: int = rules.CONTEXT_TTL_SECONDS) -> DataFrame:
    """``(patient_id, started_at)`` of each patient's newest document."""
    return _sessions(updates, ttl_seconds).groupBy(KEY).agg(F.max("started_at").alias("started_at"))


def closed_episodes(updates: DataFrame, delay: str, ttl_seconds: int = rules.CONTEXT_TTL_SECONDS) -> DataFrame:
    """Episodes of a stream of ``context_updates``, each once it has ended (append
    mode): session windows behind a watermark of ``delay``.  Updates older than the
    watermark are late and count nowhere."""
    w = F.session_window("t", f"{ttl_seconds} seconds")
    return (updates.withWatermark("t", delay).groupBy(KEY, w.alias("_w"))
            .agg(F.min("t").alias("started_at"), F.max("t").alias("last_update"), F.count(F.lit(1)).alias("updates"))
            .select(KEY, "started_at", "last_update", "updates", (F.col("last_update") + F.make_dt_interval(secs=F.lit(ttl_seconds))).alias("expires_at")))


def in_document(rows: DataFrame, starts: DataFrame, time_col: str) -> DataFrame:
    """The rows of a source that are in their patient's newest document: what came
    before its start expired with an older one."""
    s = starts.select(F.col(KEY).alias("_patient"), "started_at")
    return rows.join(s, F.col(KEY) == F.col("_patient")).where(F.col(time_col) >= F.col("started_at")).select(*rows.columns)


def context_live(episodes: DataFrame, as_of: str) -> DataFrame:
    """Documents still alive at ``as_of``: the patient's newest episode, if
    it has not expired.  Reads of expired ids find nothing."""
    return newest_episode(episodes).where(F.col("expires_at") >= F.lit(as_of).cast("timestamp"))


def all_patients(*ids: DataFrame) -> DataFrame:
    """Union of the patient ids seen by any source (distinct)."""
    out = None
    for df in ids:
        x = df.select(F.col(KEY)).where(F.coalesce(F.col(KEY), F.lit("")) != "")
        out = x if out is None else out.unionByName(x)
    return out.distinct()
