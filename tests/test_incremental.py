"""Keyset polling, change application, registry headers, observed counters, frequent
reasons and global ranks."""

import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from wardline.operators import changes, dlq, ingest
from wardline.operators.sequence import global_rank, spread, text_order
from wardline.sources import fixtures as fx
from wardline.sources import poll
from wardline.sources.stream import decode_registry_avro, stream_source, strip_registry_header
from wardline.streaming import ingest_counters, start_ingest


def test_pages_over_ties_give_the_whole_table(spark, tmp_dir):
    rows = spark.range(450).select(F.timestamp_seconds(F.floor(F.col("id") / 170) * 3600).alias("updated_at"), F.format_string("k%04d", (F.col("id") * 7) % 450).alias("key"), F.col("id").alias("x"))
    table = rows.unionByName(rows.limit(1).select(F.lit(None).cast("timestamp").alias("updated_at"), F.lit("no time").alias("key"), F.lit(0).cast("long").alias("x")))
    p = poll.Poller(spark, os.path.join(tmp_dir, "p"), lambda: table, "updated_at", "key", 100)
    sizes = []
    while n := p.poll():
        sizes.append(n)
        p = poll.Poller(spark, os.path.join(tmp_dir, "p"), lambda: table, "updated_at", "key", 100)  # a restart
    assert sizes == [100, 100, 100, 100, 50]
    got = p.rows.read()
    assert got.count() == 450 and got.select(rows.columns).exceptAll(rows).count() == 0
    # a page whose cursor was not committed is polled again; later rows come behind it
    more = table.unionByName(spark.createDataFrame([(900,)], "x long").select(F.timestamp_seconds(F.lit(7200)).alias("updated_at"), F.lit("k9999").alias("key"), "x"))
    late = poll.Poller(spark, os.path.join(tmp_dir, "p"), lambda: more, "updated_at", "key", 100)
    cursor, number = late.cursor()
    late.rows.write(poll.page(more, "updated_at", "key", cursor, 100), number)  # ended before the cursor
    assert late.poll() == 1 and late.rows.read().count() == 451 and late.poll() == 0


def test_poll_filter_reaches_the_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    spark.range(100).select(F.timestamp_seconds("id").alias("t"), F.col("id").alias("k")).write.parquet(path)
    plan = poll.page(spark.read.parquet(path), "t", "k", ("1970-01-01 00:00:50", 50), 10)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(t" in plan and "TakeOrderedAndProject" in plan


def log(seed, n=600):
    r = random.Random(seed)
    return [(r.choice("abcdefgh") + str(r.randrange(4)), r.choice("cuuud"), f"v{i}", i) for i in range(n)]


def state(rows):
    newest = {}
    for k, op, v, p in rows:
        if k not in newest or p > newest[k][2]:
            newest[k] = (op, v, p)
    return newest


def test_shuffled_and_repeated_changes_give_one_table(spark, tmp_dir):
    rows = log(1)
    want = {k: v for k, (op, v, _) in state(rows).items() if op != "d"}
    schema = "k string, op string, v string, position long"
    snapshot = [(k, None, v, p) for k, (op, v, p) in state(rows[:300]).items() if op != "d"]
    for seed in (1, 2):
        r = random.Random(seed)
        arrived = rows[250:] + r.sample(rows, 150)
        r.shuffle(arrived)
        # what a snapshot leaves out for being deleted must be in the log
        arrived += [(k, op, v, p) for k, (op, v, p) in state(rows[:300]).items() if op == "d"]
        got = changes.apply_changes(spark.createDataFrame(snapshot, schema), spark.createDataFrame(arrived, schema), ["k"])
        assert {x["k"]: x["v"] for x in got.collect()} == want
    path, files = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "in")
    r.shuffle(rows)
    for i in range(0, 600, 200):  # stale changes come in later batches
        spark.createDataFrame(rows[i:i + 200] + rows[:20], schema).coalesce(1).write.mode("append").parquet(files)
    src = stream_source(spark, "parquet", spark.createDataFrame([], schema).schema, path=files, maxFilesPerTrigger=1)
    changes.start_changes(src, ["k"], path, os.path.join(tmp_dir, "ck")).awaitTermination()
    got = changes.changes_table(spark, path, ["k"]).read().where("op != 'd'").collect()
    assert {x["k"]: x["v"] for x in got} == want


def test_registry_header(spark):
    body = b'{"a": 1}'
    rows = [(1, b"\x00\x00\x00\x00\x2a" + body), (2, b"\x00\x00\x01\x00\x00" + body), (3, b"\x01\x00\x00\x00\x2a" + body), (4, b"\x00\x00"), (5, None), (6, b"\x00\x00\x00\x00\x2a")]
    df = spark.createDataFrame(rows, "n int, value binary")
    got = {x["n"]: (x["schema_id"], x["value"] and bytes(x["value"])) for x in strip_registry_header(df).collect()}
    assert got == {1: (42, body), 2: (65536, body), 3: (None, None), 4: (None, None), 5: (None, None), 6: (42, b"")}
    # each number goes to its own writer schema; JSON stands for the body here
    seen = []

    def decode(column, writer, reader):
        seen.append((writer, reader))
        return F.when(F.length(column) > 0, F.from_json(column.cast("string"), "a int"))
    out = {x["n"]: (x["schema_id"], x["a"], x["_corrupt"]) for x in decode_registry_avro(df, {42: "w42", 7: "w7"}, "r", decode=decode).collect()}
    assert seen == [("w7", "r"), ("w42", "r")]
    assert out == {1: (42, 1, False), 2: (65536, None, True), 3: (None, None, True), 4: (None, None, True), 5: (None, None, False), 6: (42, None, True)}


def test_observed_counters_equal_the_batch(spark, tmp_dir):
    obs, pats = fx.observations(spark, SF_SMALL), fx.patients(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "in")
    obs.repartition(3).write.parquet(path)
    src = stream_source(spark, "parquet", obs.schema, path=path, maxFilesPerTrigger=1)
    out = os.path.join(tmp_dir, "out")
    start_ingest(src, pats, out, os.path.join(tmp_dir, "ck")).awaitTermination()
    want = ingest.ingest_stats(ingest.classify_observations(obs, ingest.patients_dim(pats))).first()
    assert ingest_counters(spark, out).first().asDict() == want.asDict() and want["total"] > 0


@pytest.mark.parametrize("tracked", [100_000, 512, 64])
def test_top_reasons_are_exact(spark, tracked):
    r = random.Random(4)
    rows = [(f"R{min(int(r.paretovariate(0.8)), 5000)}: value",) for _ in range(20_000)] + [(None,)] * 37 + [(f"once {i}",) for i in range(3000)]
    table = spark.createDataFrame(rows, "error_reason string").repartition(6)
    want = table.groupBy(F.coalesce("error_reason", F.lit("unknown")).alias("reason")).count().orderBy(F.desc("count"), "reason").limit(10).collect()
    got = dlq.top_reasons(table, 10, tracked).orderBy("rank").collect()
    assert [(x["reason"], x["errors"]) for x in got] == [(x["reason"], x["count"]) for x in want] and [x["rank"] for x in got] == list(range(1, 11))
    assert dlq.top_reasons(table.limit(0)).count() == 0


def test_global_rank_equals_one_window(spark):
    from pyspark.sql import Window
    r = random.Random(2)
    rows = [(r.choice([1, 1, 1, 2, 7, 300]), r.choice(["P", "Q\u00e9", ""]) + f"{r.randrange(10**9):010d}") for _ in range(5000)] + [(1, ""), (2, "z" * 50)]
    df = spark.createDataFrame(rows, "n long, id string").distinct().repartition(7)
    got = global_rank(df, ["n", "id"], [F.col("n"), spread(df, "id", 16)])
    want = df.withColumn("rank", F.row_number().over(Window.orderBy("n", "id")).cast("long"))
    assert got.exceptAll(want).count() == 0 and got.count() == df.count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "specifiedwindowframe" in plan
    low = df.select(text_order(F.col("id")).alias("o"), "id").orderBy("id").collect()
    assert [x["o"] for x in low] == sorted(x["o"] for x in low)
