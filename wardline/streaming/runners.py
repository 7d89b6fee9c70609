"""Structured Streaming runners for the wardline operators.

* Stateless operators (validation, anomalies, quality stream) run in
  ``append`` mode; the validator's two branches are written from one
  persisted micro-batch inside ``foreachBatch``.
* Continuously updated tables (per-key lists, windowed statistics) run in
  ``update`` mode with a watermark and are merged into a keyed table.
* The patient context is folded per micro-batch: the stored per-key partial
  state (newest readings, list entries) is unioned with the batch and
  re-aggregated with the same partial aggregates the batch operators use.

Exactly-once: the checkpoint records the offsets, and every sink write is
keyed by ``batch_id`` -- a replayed batch overwrites the same table version
(dynamic partition overwrite), so re-execution after an executor or driver
loss is idempotent.  Checkpoints and tables live under the shared folder
named by ``spark.checkpoint.dir`` (see ``wardline.session``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardline import rules
from wardline.operators import context as ctx
from wardline.operators import ingest
from wardline.streaming.keyed import KeyedTable, folders


class VersionedTable:
    """A parquet table with one partition per committed micro-batch
    (``v = batch_id``).  Writing version v overwrites only that partition, so
    replays are idempotent; readers take the newest complete version, or the
    newest base and the versions after it.

    A base holds everything up to a version in one partition of a table beside
    this one; a pointer row written after it commits it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, df: DataFrame, version: int) -> None:
        (df.withColumn("v", F.lit(int(version)).cast("long")).write
         .mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("v").parquet(self.path))

    def latest_version(self, before: int | None = None) -> int | None:
        if not folders(self.spark, self.path, "v="):
            return None  # no rows yet; any failure of a read stops the caller
        d = self.spark.read.parquet(self.path)
        if before is not None:
            d = d.where(F.col("v") < before)
        return d.agg(F.max("v")).first()[0]  # answered from partition values

    def _beside(self, what: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.path}_{what}")

    def read_all(self, before: int | None = None) -> DataFrame | None:
        """The newest committed base (older than ``before``) and the rows of every
        version after it."""
        base = self._beside("pointer").latest_version(before)
        last = self.latest_version(before)
        if last is None:
            return None
        d = self.spark.read.parquet(self.path)
        if before is not None:
            d = d.where(F.col("v") < before)
        if base is None:
            return d.drop("v")
        old = self.spark.read.parquet(self._beside("base").path).where(F.col("v") == base)
        return old.unionByName(d.where(F.col("v") > base)).drop("v")

    def write_base(self, df: DataFrame, version: int) -> None:
        """Commit ``df`` as everything up to ``version``."""
        self._beside("base").write(df, version)
        self._beside("pointer").write(self.spark.range(1), version)

    def read(self, before: int | None = None) -> DataFrame | None:
        v = self.latest_version(before)
        if v is None:
            return None
        return self.spark.read.parquet(self.path).where(F.col("v") == v).drop("v")


def start_ingest(obs_stream: DataFrame, patients: DataFrame, out_dir: str, checkpoint: str,
                 trigger: dict | None = None):
    """Validate and enrich a stream of observation rows; valid vitals and
    dead letters are appended to two tables from the same persisted batch
    (stream-static join against the patient dimension).  The batch's counters are
    observed while it is computed, without a scan of their own, and kept by batch
    (``ingest_counters``)."""
    dim = ingest.patients_dim(patients)

    def batch(df: DataFrame, batch_id: int) -> None:
        seen = Observation("ingest")
        c = ingest.classify_observations(df, dim).observe(seen, *ingest.counters()).persist()
        try:
            VersionedTable(df.sparkSession, f"{out_dir}/vitals").write(
                ingest.enrich_vitals(c.where("is_valid")), batch_id)
            VersionedTable(df.sparkSession, f"{out_dir}/dlq").write(
                ingest.dlq_records(c.where(F.col("is_vital") & ~F.col("is_valid"))), batch_id)
            row = df.sparkSession.createDataFrame([seen.get], ", ".join(f"{n} long" for n in ingest.COUNTERS))
            VersionedTable(df.sparkSession, f"{out_dir}/counters").write(row, batch_id)
        finally:
            c.unpersist()

    w = obs_stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def ingest_counters(spark: SparkSession, out_dir: str) -> DataFrame:
    """The producer's counters over all committed batches of ``start_ingest``."""
    return spark.read.parquet(f"{out_dir}/counters").agg(*[F.sum(n).alias(n) for n in ingest.COUNTERS])


def start_append(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, fmt: str = "parquet"):
    """Append-mode sink for stateless derived streams (file sink is
    exactly-once through its commit log)."""
    return (df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
            .option("path", path).trigger(**(trigger or {"availableNow": True})).start())


def start_update_table(agg: DataFrame, keys: list[str], path: str, checkpoint: str,
                       trigger: dict | None = None, buckets: int = 8, compact_every: int = 50):
    """Update-mode aggregate into a ``KeyedTable``: a batch writes its changed rows
    only, readers merge them by key; every ``compact_every`` batches what was
    committed before becomes the base."""
    def batch(df: DataFrame, batch_id: int) -> None:
        t = KeyedTable(df.sparkSession, path, keys, buckets)
        if batch_id and batch_id % compact_every == 0:
            t.compact(batch_id - 1)
        t.write(df, batch_id)

    return (agg.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _merge_history(rows: DataFrame, n: int) -> DataFrame:
    # readings are immutable: de-duplicate (replays, versions) and keep the newest n
    rows = rows.dropDuplicates(["patient_id", "vital", "rec_offset"])
    keep = ctx.vitals_history(rows, n).select("patient_id", "vital", "rec_offset")
    return rows.join(keep, ["patient_id", "vital", "rec_offset"])


def _merge_entries(rows: DataFrame, entry: list[str]) -> DataFrame:
    # list entries are partial aggregates: newest entry by last offset, first offset = min
    g = rows.groupBy("patient_id", "name").agg(
        F.max_by(F.struct(*entry), F.col("last_offset")).alias("_e"),
        F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"))
    return g.select("patient_id", "name", *[F.col(f"_e.{c}").alias(c) for c in entry], "first_offset", "last_offset")


_HIST_COLS = ["patient_id", "vital", "rec_offset", "value", "timestamp", "units", "patient_age", "patient_gender"]
_ENTRIES = {"conditions": ("condition_name", ["condition_code", "status", "severity"]),
            "medications": ("medication_name", ["dosage", "frequency", "route", "status"])}


def fold_context_batch(spark: SparkSession, readings: DataFrame | None, conditions: DataFrame | None,
                       medications: DataFrame | None, state_dir: str, batch_id: int,
                       n: int = rules.HISTORY_LEN) -> None:
    """One micro-batch of the context fold.

    State tables (one version per batch): ``history`` (newest n readings per
    patient x vital) and ``conditions`` / ``medications`` list entries.  Only
    the patients touched by the batch are read back (semi join) and written:
    their stored rows from earlier versions are merged with the batch's own
    fold, and the merged state of just those patients becomes version
    ``batch_id``.  Both merges are associative and idempotent, so readers
    merge across versions (``context_state``) and a replayed batch rewrites
    the same version.
    """
    if readings is not None:
        hist_t = VersionedTable(spark, f"{state_dir}/history")
        r = readings.select(*_HIST_COLS)
        prev = hist_t.read_all(before=batch_id)
        if prev is not None:
            touched = r.select("patient_id").distinct()
            r = prev.select(*_HIST_COLS).join(touched, "patient_id", "left_semi").unionByName(r)
        hist_t.write(_merge_history(r, n), batch_id)

    for name, log in (("conditions", conditions), ("medications", medications)):
        if log is None:
            continue
        name_col, entry = _ENTRIES[name]
        t = VersionedTable(spark, f"{state_dir}/{name}")
        fresh = ctx.upsert_list(log, name_col, entry)
        old = t.read_all(before=batch_id)
        if old is not None:
            touched = fresh.select("patient_id").distinct()
            fresh = _merge_entries(old.join(touched, "patient_id", "left_semi").unionByName(fresh), entry)
        t.write(fresh, batch_id)


def context_state(spark: SparkSession, state_dir: str, n: int = rules.HISTORY_LEN) -> dict[str, DataFrame]:
    """Current context state merged across all committed versions."""
    out = {}
    h = VersionedTable(spark, f"{state_dir}/history").read_all()
    if h is not None:
        out["history"] = _merge_history(h, n)
    for name, (_, entry) in _ENTRIES.items():
        e = VersionedTable(spark, f"{state_dir}/{name}").read_all()
        if e is not None:
            out[name] = _merge_entries(e, entry)
    return out


def compact_state(spark: SparkSession, state_dir: str, version: int, n: int = rules.HISTORY_LEN) -> None:
    """Commit the state merged up to ``version``, a batch that has been committed,
    as each table's base: readers and later folds then scan the base and the
    versions after it only."""
    h = VersionedTable(spark, f"{state_dir}/history")
    parts = [(h, lambda d: _merge_history(d, n))]
    parts += [(VersionedTable(spark, f"{state_dir}/{name}"), lambda d, entry=entry: _merge_entries(d, entry)) for name, (_, entry) in _ENTRIES.items()]
    for table, merge in parts:
        rows = table.read_all(before=version + 1)
        if rows is not None:
            table.write_base(merge(rows), version)


def start_context(readings_stream: DataFrame | None, state_dir: str, checkpoint: str, trigger: dict | None = None,
                  conditions_stream: DataFrame | None = None, medications_stream: DataFrame | None = None):
    """The three streams -> incrementally folded context state, each into its own
    table by a query of its own; returns the queries that were started (the one
    query if there is one stream)."""
    def start(stream: DataFrame, name: str, fold):
        def batch(df: DataFrame, batch_id: int) -> None:
            fold(df.sparkSession, df, batch_id)

        where = checkpoint if name == "history" else f"{checkpoint}-{name}"
        return (stream.writeStream.foreachBatch(batch).option("checkpointLocation", where)
                .trigger(**(trigger or {"availableNow": True})).start())

    folds = [
        (readings_stream, "history", lambda s, df, i: fold_context_batch(s, ctx.vital_readings(df), None, None, state_dir, i)),
        (conditions_stream, "conditions", lambda s, df, i: fold_context_batch(s, None, df, None, state_dir, i)),
        (medications_stream, "medications", lambda s, df, i: fold_context_batch(s, None, None, df, state_dir, i))]
    queries = [start(stream, name, fold) for stream, name, fold in folds if stream is not None]
    return queries[0] if len(queries) == 1 else queries
