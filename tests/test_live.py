"""Keyed tables and live documents: stream = batch after every micro-batch, expiry at
exactly and just over the time to live, restarts, late rows, hot patients."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from wardline.operators import context as ctx
from wardline.sources.stream import stream_source
from wardline.streaming import KeyedTable, live_documents, start_documents
from wardline.streaming import live

DAY = 86_400_000_000
READING = "patient_id string, vital string, ingest_ts timestamp, rec_offset long, value double, units string, timestamp string, patient_age int, patient_gender string"
CONDITION = "patient_id string, condition_name string, updated_at timestamp, rec_offset long, condition_code string, status string, severity string"
MEDICATION = "patient_id string, medication_name string, updated_at timestamp, rec_offset long, dosage string, frequency string, route string, status string"


def frame(spark, rows, schema):
    """Rows whose third column is microseconds."""
    time = [f.split()[0] for f in schema.split(", ")][2]
    raw = spark.createDataFrame(rows, schema.replace(f"{time} timestamp", f"{time} long"))
    return raw.withColumn(time, F.timestamp_micros(time))


def sources(seed=1, n=400, patients=6, days=20):
    """Three logs in arrival order, times roughly rising, with gaps around a day."""
    r = random.Random(seed)
    out = ([], [], [])
    for i in range(n):
        t = int(i / n * days * DAY) + r.randint(0, DAY // 3)
        p = r.choice(["hot"] * 3 + [f"p{k}" for k in range(patients)]) if r.random() < 0.97 else r.choice(["", None])
        k = r.random()
        if k < 0.6:
            out[0].append((p, r.choice(["heart_rate", "temperature"]), t, i, r.choice([0.0, 98.6, 72.25, 101.3, 80.0]), "u", f"ts{i}", r.randint(1, 90), r.choice("MF")))
        elif k < 0.8:
            out[1].append((p, r.choice(["flu", "asthma", "x y", None]), t, i, f"c{i}", r.choice(["active", "done"]), None))
        else:
            out[2].append((p, r.choice(["aspirin", "insulin"]), t, i, f"{i}mg", "daily", "oral", "active"))
    return out


def batch_documents(spark, logs):
    r, c, m = (frame(spark, rows, schema) for rows, schema in zip(logs, (READING, CONDITION, MEDICATION), strict=True))
    starts = ctx.document_starts(ctx.context_updates(r, c, m))
    docs = ctx.context_document(ctx.in_document(r, starts, "ingest_ts"), ctx.in_document(c, starts, "updated_at"), ctx.in_document(m, starts, "updated_at"))
    return canonical(docs)


def canonical(docs):
    return {x["patient_id"]: json.loads(x["j"]) for x in docs.select("patient_id", F.to_json(F.struct(
        "patient_age", "patient_gender", "vitals", "vitals_history", "conditions", "medications"), {"ignoreNullFields": "false"}).alias("j")).collect()}


def feed(spark, tmp_dir, steps):
    """Streams over folders; ``step()`` adds the next files to them."""
    schemas = (READING, CONDITION, MEDICATION)
    paths = [os.path.join(tmp_dir, k) for k in live.KINDS]
    at = iter(steps)

    def step():
        for rows, schema, path in zip(next(at), schemas, paths, strict=True):
            frame(spark, rows, schema).coalesce(1).write.mode("append").parquet(path)

    def streams():
        return [stream_source(spark, "parquet", frame(spark, [], schema).schema, path=path) for schema, path in zip(schemas, paths, strict=True)]
    return step, streams


def in_steps(logs, n):
    last = max(rows[-1][3] for rows in logs) + 1
    return [tuple([x for x in rows if i * last // n <= x[3] < (i + 1) * last // n] for rows in logs) for i in range(n)]


def test_documents_equal_batch_after_every_micro_batch(spark, tmp_dir):
    logs = sources()
    steps = in_steps(logs, 4)
    step, streams = feed(spark, tmp_dir, steps)
    out, check = os.path.join(tmp_dir, "docs"), os.path.join(tmp_dir, "ck")
    seen = ([], [], [])
    for part in steps:  # every micro-batch by a query of its own: each is a restart from the checkpoint
        for all_, more in zip(seen, part, strict=True):
            all_.extend(more)
        step()
        start_documents(*streams(), out, check, delay="60 days").awaitTermination()
        assert canonical(live_documents(spark, out)) == batch_documents(spark, seen)


def one(offset, t, patient="a", value=70.0):
    return (patient, "heart_rate", t, offset, value, "bpm", f"ts{offset}", 40, "F")


@pytest.mark.parametrize("gap, left", [(DAY, 2), (DAY + 1, 1)])
def test_gap_of_exactly_and_just_over_a_day(spark, tmp_dir, gap, left):
    first, t = [one(1, 10 * DAY)], 10 * DAY + gap
    other = [("b", "flu", 10 * DAY, 2, "c", "s", "v")], [("b", "aspirin", 10 * DAY, 3, "d", "f", "r", "s")]
    step, streams = feed(spark, tmp_dir, [(first, *other), ([one(4, t, value=80.0)], [], [])])
    out, check = os.path.join(tmp_dir, "docs"), os.path.join(tmp_dir, "ck")
    for _ in range(2):
        step()
        start_documents(*streams(), out, check, delay="2 days").awaitTermination()
    doc = live_documents(spark, out).where("patient_id = 'a'").first()
    assert len(doc["vitals_history"]["heart_rate_history"]) == left
    assert (doc["vitals"]["heart_rate"]["trend"] is not None) == (left == 2)


def test_timer_ends_documents_and_late_rows_are_left_out(spark, tmp_dir):
    quiet = [("a", "flu", 11 * DAY, 2, "c", "s", "v")], [("c", "aspirin", 11 * DAY, 3, "d", "f", "r", "s")]
    later = [("c", "flu", 30 * DAY, 5, "c", "s", "v")], [("c", "aspirin", 30 * DAY, 6, "d", "f", "r", "s")]
    last = [("c", "flu", 31 * DAY, 8, "c", "s", "v")], [("c", "aspirin", 31 * DAY, 9, "d", "f", "r", "s")]
    step, streams = feed(spark, tmp_dir, [([one(1, 10 * DAY)], *quiet), ([one(4, 30 * DAY, "c")], *later), ([one(7, 10 * DAY + 5, "late"), one(10, 31 * DAY, "c")], *last)])
    out, check = os.path.join(tmp_dir, "docs"), os.path.join(tmp_dir, "ck")
    step()
    start_documents(*streams(), out, check, delay="1 hour").awaitTermination()
    assert set(canonical(live_documents(spark, out))) == {"a", "c"}
    for _ in range(2):
        step()
        start_documents(*streams(), out, check, delay="1 hour").awaitTermination()
    assert set(canonical(live_documents(spark, out))) == {"c"}  # a's timer fired; the late row made no document
    ended = KeyedTable(spark, out, ["patient_id"]).read().where("expired").collect()
    assert {x["patient_id"] for x in ended} == {"a"}


def test_segments_of_any_split_give_the_same_documents():
    r = random.Random(7)
    for _ in range(60):
        updates, t = [], 0
        for i in range(40):
            t += r.choice([1, DAY // 2, DAY, DAY + 1])
            kind = r.randrange(3)
            updates.append(live._of_row(t, kind, r.randrange(1000) * 40 + i, r.choice("xy"), float(i), "u", "s", i, "F", [f"{i}", "b", "c", "d"]))
        whole = live.united(updates, DAY, 10)
        r.shuffle(updates)
        cut = sorted(r.sample(range(40), 3))
        parts = [updates[a:b] for a, b in zip([0, *cut], [*cut, 40], strict=True)]
        folded = [x for p in parts for x in live.united(p, DAY, 10)]
        assert live.united(folded + folded[:3], DAY, 10) == whole


def test_a_hot_patient_sends_one_row_for_each_batch_of_a_task(spark):
    rows = [one(i, 10 * DAY + i * 1000, "hot", float(i)) for i in range(20_000)] + [one(i, 10 * DAY, f"p{i}") for i in range(100)]
    empty = frame(spark, [], CONDITION), frame(spark, [], MEDICATION)
    folded = live.segments(live.tagged(frame(spark, rows, READING).repartition(4), *empty)[0])
    sizes = [len(x["segment"]) for x in folded.where("patient_id = 'hot'").collect()]
    assert len(sizes) <= 8 and max(sizes) < 2000


def test_keyed_table_merges_on_read(spark, tmp_dir):
    t = KeyedTable(spark, os.path.join(tmp_dir, "t"), ["k"], buckets=4, gone="gone")
    row = lambda ids, x, gone=False: spark.createDataFrame([(i, x, gone) for i in ids], "k long, x string, gone boolean")
    assert t.read() is None
    t.write(row(range(1000), "a"), 0)
    t.write(row([1, 2], "b"), 1)
    t.write(row([1, 2], "b"), 1)  # a replay
    t.write(row([3], "c", True), 2)
    values = lambda df: {r["k"]: r["x"] for r in df.collect()}
    want = {i: "a" for i in range(1000)} | {1: "b", 2: "b"}
    assert values(t.read(before=2)) == want
    want.pop(3)
    assert values(t.read()) == want
    some = t.read(within=spark.createDataFrame([(1,), (3,), (7,), (5000,)], "k long"))
    assert values(some) == {1: "b", 7: "a"}
    size = lambda v: sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{t.path}/delta/v={v}") for f in fs if f.endswith(".parquet"))
    assert size(1) < size(0) / 2  # bytes follow the batch
    t.compact(2)
    assert values(t.read()) == want and values(t.read(before=1)) == {i: "a" for i in range(1000)}
    t.write(row([9], "d"), 3)
    assert values(t.read()) == want | {9: "d"}
    t.write(row([], "e"), 4)  # a batch without rows
    assert values(t.read()) == want | {9: "d"}
    t._put(row(range(1000), "broken"), "delta", 5)  # written, never committed
    assert values(t.read()) == want | {9: "d"}


def test_a_failing_read_stops_the_batch(spark, tmp_dir):
    t = KeyedTable(spark, os.path.join(tmp_dir, "t"), ["k"])
    t.write(spark.range(10).withColumnRenamed("id", "k").withColumn("x", F.lit(1)), 0)
    part = next(os.path.join(d, f) for d, _, fs in os.walk(f"{t.path}/delta") for f in fs if f.endswith(".parquet"))
    with open(part, "wb") as f:
        f.write(b"damaged")
    with pytest.raises(Exception):  # noqa: B017
        t.read().collect()
    with pytest.raises(Exception):  # noqa: B017
        t.compact(0)
    assert t._versions("pointer") == []


def test_closed_episodes_equal_batch(spark, tmp_dir):
    r = random.Random(5)
    rows, t = [], 0
    for i in range(300):
        t += r.choice([60_000_000, DAY // 3, DAY // 2])
        rows.append((r.choice("aab"), t, r.randrange(3), i))
    for p in "cd":  # gaps of exactly and just over a day
        rows += [(p, 5 * DAY, 0, 1000), (p, 6 * DAY + (p == "d"), 0, 1001)]
    last = max(x[1] for x in rows)
    end = [("z", last + 10 * DAY, 0, 2000), ("z", last + 11 * DAY, 0, 2001)]  # moves the watermark past all others
    frame_of = lambda x: spark.createDataFrame(x, "patient_id string, t long, src int, rec_offset long").withColumn("t", F.timestamp_micros("t"))
    path = os.path.join(tmp_dir, "in")
    rows.sort(key=lambda x: x[1])
    for part in (rows[:100], rows[100:], end[:1], end[1:]):
        frame_of(part).coalesce(1).write.mode("append").parquet(path)
    src = stream_source(spark, "parquet", frame_of(rows).schema, path=path, maxFilesPerTrigger=1)
    out = os.path.join(tmp_dir, "out")
    (ctx.closed_episodes(src, "1 hour").writeStream.format("parquet").outputMode("append").option("checkpointLocation", os.path.join(tmp_dir, "ck"))
     .option("path", out).trigger(availableNow=True).start().awaitTermination())
    got = spark.read.parquet(out)
    want = ctx.context_episodes(frame_of(rows)).drop("episode")
    assert want.where("patient_id = 'c'").count() == 1 and want.where("patient_id = 'd'").count() == 2
    assert got.where("patient_id <> 'z'").select(want.columns).exceptAll(want).count() == 0
    assert got.where("patient_id <> 'z'").count() == want.count()
