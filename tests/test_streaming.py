"""Stream = batch: the same operators through a file stream (several files,
availableNow) give the batch result."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from wardline.operators import context as ctx
from wardline.operators import ingest, tables
from wardline.sources import fixtures as fx
from wardline.sources.stream import stream_source
from wardline.streaming import (KeyedTable, VersionedTable, compact_state, context_state, fold_context_batch, start_append,
                                start_context, start_ingest, start_update_table)


def _write_in_order(df, path, parts=4):
    """Several files written one after the other in arrival order, so the
    file stream (oldest file first) replays the log in order and
    availableNow runs several micro-batches."""
    b = df.select(F.percentile_approx("rec_offset", [i / parts for i in range(1, parts)])).first()[0]
    edges = [None, *b, None]
    for i in range(parts):
        lo, hi = edges[i], edges[i + 1]
        part = df
        if lo is not None:
            part = part.where(F.col("rec_offset") > lo)
        if hi is not None:
            part = part.where(F.col("rec_offset") <= hi)
        part.coalesce(1).write.mode("append").parquet(path)


def _obs_files(spark, tmp_dir):
    obs = fx.observations(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "obs_in")
    _write_in_order(obs, path)
    return obs, path


def test_ingest_stream_equals_batch(spark, tmp_dir):
    obs, path = _obs_files(spark, tmp_dir)
    pats = fx.patients(spark, SF_SMALL)
    src = stream_source(spark, "parquet", obs.schema, path=path, maxFilesPerTrigger=1)
    out = os.path.join(tmp_dir, "out")
    q = start_ingest(src, pats, out, os.path.join(tmp_dir, "ck1"))
    q.awaitTermination()
    got = spark.read.parquet(f"{out}/vitals").drop("v")
    exp = ingest.process_vitals(obs, pats)
    assert got.count() == exp.count()
    assert got.select(sorted(exp.columns)).exceptAll(exp.select(sorted(exp.columns))).count() == 0
    dlq = spark.read.parquet(f"{out}/dlq")
    assert dlq.count() + got.count() == ingest.vitals_only(obs).count()


def test_anomaly_stream_append(spark, tmp_dir):
    obs, path = _obs_files(spark, tmp_dir)
    # the static side of a stream-static join is materialised once (reliable
    # checkpoint in spark.checkpoint.dir)
    pats = ingest.patients_dim(fx.patients(spark, SF_SMALL)).checkpoint()
    src = stream_source(spark, "parquet", obs.schema, path=path, maxFilesPerTrigger=2)
    valid, _ = ingest.validate_vitals(src, pats)
    an = tables.vital_anomalies(ingest.enrich_vitals(valid))
    out = os.path.join(tmp_dir, "anom")
    start_append(an, out, os.path.join(tmp_dir, "ck2")).awaitTermination()
    exp = tables.vital_anomalies(ingest.process_vitals(obs, fx.patients(spark, SF_SMALL)))
    assert spark.read.parquet(out).count() == exp.count()


def test_window_stats_update_mode(spark, tmp_dir):
    obs, path = _obs_files(spark, tmp_dir)
    pats = ingest.patients_dim(fx.patients(spark, SF_SMALL)).checkpoint()
    src = stream_source(spark, "parquet", obs.schema, path=path, maxFilesPerTrigger=1)
    valid, _ = ingest.validate_vitals(src.withWatermark("ingest_ts", "24 hours"), pats)
    agg = tables.window_count(ingest.enrich_vitals(valid), keys=("patient_id",), size="1 hour")
    out = os.path.join(tmp_dir, "wc")
    start_update_table(agg, ["patient_id", "window_start"], out, os.path.join(tmp_dir, "ck3")).awaitTermination()
    got = KeyedTable(spark, out, ["patient_id", "window_start"]).read()
    exp = tables.window_count(ingest.process_vitals(obs, fx.patients(spark, SF_SMALL)), keys=("patient_id",),
                              size="1 hour")
    assert got.count() == exp.count()
    assert got.select(exp.columns).exceptAll(exp).count() == 0


def test_context_fold_equals_batch(spark, tmp_dir):
    obs = fx.observations(spark, SF_SMALL)
    vit = ingest.process_vitals(obs, fx.patients(spark, SF_SMALL))
    path = os.path.join(tmp_dir, "vit_in")
    _write_in_order(vit, path, 3)
    src = stream_source(spark, "parquet", vit.schema, path=path, maxFilesPerTrigger=1)
    state = os.path.join(tmp_dir, "state")
    start_context(src, state, os.path.join(tmp_dir, "ck4")).awaitTermination()
    hist = context_state(spark, state)["history"]
    exp = ctx.vitals_history(ctx.vital_readings(vit))
    assert hist.count() == exp.count()
    assert hist.select("patient_id", "vital", "rec_offset").exceptAll(
        exp.select("patient_id", "vital", "rec_offset")).count() == 0
    tr_stream = ctx.vital_trends(ctx.vitals_history(hist))
    tr_batch = ctx.vital_trends(exp)
    assert tr_stream.exceptAll(tr_batch).count() == 0


def test_versioned_table_replay_is_idempotent(spark, tmp_dir):
    t = VersionedTable(spark, os.path.join(tmp_dir, "vt"))
    t.write(spark.range(5), 0)
    t.write(spark.range(3), 1)
    t.write(spark.range(3), 1)  # replayed batch overwrites its own version
    assert t.read().count() == 3 and t.read(before=1).count() == 5
    assert t.read().agg(F.sum("id")).first()[0] == 3


def test_list_fold_touches_only_batch_keys(spark, tmp_dir):
    """Condition log folded in three batches equals the batch upsert; each
    version holds only the patients of its batch; compaction keeps the state."""
    cond = fx.conditions(spark, SF_SMALL)
    state = os.path.join(tmp_dir, "lstate")
    empty = spark.createDataFrame([], "patient_id string, vital string, rec_offset long, value double, "
                                      "timestamp string, units string, patient_age int, patient_gender string")
    parts = [cond.where(F.col("rec_offset") <= 3), cond.where(F.col("rec_offset").between(4, 6)),
             cond.where(F.col("rec_offset") > 6)]
    for i, p in enumerate(parts):
        fold_context_batch(spark, empty, p, None, state, i)
    got = context_state(spark, state)["conditions"]
    exp = ctx.latest_conditions(cond)
    cols = sorted(exp.columns)
    assert got.select(cols).exceptAll(exp.select(cols)).count() == 0
    assert exp.select(cols).exceptAll(got.select(cols)).count() == 0
    v1 = spark.read.parquet(f"{state}/conditions").where("v = 1").select("patient_id").distinct().count()
    assert v1 == parts[1].select("patient_id").distinct().count()
    table = VersionedTable(spark, f"{state}/conditions")
    before = table.read_all().count()
    compact_state(spark, state, 2)
    got2 = context_state(spark, state)["conditions"]
    assert got2.select(cols).exceptAll(exp.select(cols)).count() == 0
    assert table.read_all().count() == exp.count() < before  # readers scan the base alone
    # a batch after the base: a replay of it, too, is read with the base
    again = cond.where(F.col("rec_offset") == 1).limit(1).withColumn("rec_offset", F.lit(10**6).cast("long")).withColumn("status", F.lit("changed"))
    for _ in range(2):
        fold_context_batch(spark, empty, again, None, state, 3)
    got3 = context_state(spark, state)["conditions"]
    assert got3.count() == exp.count() and got3.where("status = 'changed'").count() == 1
    assert table.read_all().count() <= exp.count() + again.join(exp, "patient_id").count()
    assert table.read_all(before=2).count() < before  # older readers see no later base


def test_context_of_three_streams(spark, tmp_dir):
    cond, med = fx.conditions(spark, SF_SMALL), fx.medications(spark, SF_SMALL)
    obs = fx.observations(spark, SF_SMALL)
    vit = ingest.process_vitals(obs, fx.patients(spark, SF_SMALL))
    streams = []
    for name, df in (("v", vit), ("c", cond), ("m", med)):
        _write_in_order(df, os.path.join(tmp_dir, name), 2)
        streams.append(stream_source(spark, "parquet", df.schema, path=os.path.join(tmp_dir, name), maxFilesPerTrigger=1))
    state = os.path.join(tmp_dir, "three")
    for q in start_context(streams[0], state, os.path.join(tmp_dir, "ck7"), conditions_stream=streams[1], medications_stream=streams[2]):
        q.awaitTermination()
    got = context_state(spark, state)
    for name, exp in (("conditions", ctx.latest_conditions(cond)), ("medications", ctx.latest_medications(med))):
        cols = sorted(exp.columns)
        assert got[name].count() == exp.count() and got[name].select(cols).exceptAll(exp.select(cols)).count() == 0
    assert got["history"].count() == ctx.vitals_history(ctx.vital_readings(vit)).count()


def test_list_table_update_mode_equals_batch(spark, tmp_dir):
    cond = fx.conditions(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "cond_in")
    _write_in_order(cond.withColumn("rec_offset", F.col("rec_offset")), path, 3)
    src = stream_source(spark, "parquet", cond.schema, path=path, maxFilesPerTrigger=1)
    out = os.path.join(tmp_dir, "cl")
    start_update_table(tables.conditions_latest(src), ["patient_id"], out,
                       os.path.join(tmp_dir, "ck5")).awaitTermination()
    got = KeyedTable(spark, out, ["patient_id"]).read()
    exp = tables.conditions_latest(cond)
    assert got.count() == exp.count()
    assert got.select(exp.columns).exceptAll(exp).count() == 0


def test_dedup_within_watermark_on_stream(spark, tmp_dir):
    from wardline.operators.logs import dedup_events
    obs = fx.observations(spark, SF_SMALL).select("source_system", "rec_offset", "ingest_ts", "PATIENT")
    resent = obs.where(F.col("rec_offset") % 50 == 0)
    path = os.path.join(tmp_dir, "dup_in")
    _write_in_order(obs.unionByName(resent), path, 3)
    src = stream_source(spark, "parquet", obs.schema, path=path, maxFilesPerTrigger=1)
    out = os.path.join(tmp_dir, "dedup")
    start_append(dedup_events(src, ["source_system", "rec_offset"], watermark="1 hour"), out,
                 os.path.join(tmp_dir, "ck6")).awaitTermination()
    assert spark.read.parquet(out).count() == obs.count()
