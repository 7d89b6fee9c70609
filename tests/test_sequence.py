"""The bucketed sequence primitive equals window functions, also when one key
holds a third of the rows, and keeps partitions balanced."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wardline.operators.readmit import readmissions
from wardline.operators.sequence import sequence_ops


def rows(spark, n, width):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("k"),
        F.when(F.col("id") > 5, F.col("id") * width).alias("o"), F.col("id").alias("tie"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 7).cast("int")).alias("x"), (F.col("id") * 1.5).alias("y"),
        F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.lit("payload").alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("q"))


def expected(df):
    w = Window.partitionBy("k").orderBy("o", "tie")
    return df.select("*", F.row_number().over(w).cast("long").alias("rn"),
                     F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long").alias("cx"),
                     F.lag("x").over(w).alias("lx"), F.lag("ts").over(w).alias("lts"),
                     F.lead("y").over(w).alias("ny"))


@pytest.mark.parametrize("n,width", [(30_000, 1), (30_000, 40_000), (400_000, 7)])
def test_equals_window(spark, n, width):
    df = rows(spark, n, width)
    s = sequence_ops(df, "k", ["o", "tie"], row_number="rn", running_sums={"cx": "x"},
                     lags={"lx": "x", "lts": "ts"}, leads={"ny": "y"})
    e = expected(df)
    assert s.count() == n and s.exceptAll(e).count() == 0


def test_without_hot_keys_one_shuffle_does(spark):
    df = rows(spark, 9_000, 40_000).cache()
    ops = {"row_number": "rn", "running_sums": {"cx": "x"}, "lags": {"lx": "x", "lts": "ts"}, "leads": {"ny": "y"}}
    for weigh in (None, df.select("k"), df.select("k").limit(0)):
        s = sequence_ops(df, "k", ["o", "tie"], **ops, weigh=weigh)
        e = expected(df)
        assert s.schema == e.schema and s.exceptAll(e).count() == 0 and e.exceptAll(s).count() == 0
        assert s._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_null_and_missing_hot_keys(spark):
    df = rows(spark, 30_000, 40_000)
    only_null = df.where("k is null").unionAll(df.where("k = 'k1'"))
    weigh = spark.range(6_000).selectExpr("cast(null as string) as k").unionAll(spark.range(6_000).selectExpr("'absent' as k"))
    s = sequence_ops(only_null, "k", ["o", "tie"], row_number="rn", running_sums={"cx": "x"}, lags={"lx": "x", "lts": "ts"}, leads={"ny": "y"}, weigh=weigh)
    e = expected(only_null)
    assert s.count() == e.count() and s.exceptAll(e).count() == 0


def test_numbering_of_order_lines(spark, tmp_dir):
    """Lines that repeat their keys, orders and parts: numbered as one window over all
    columns does, in four shuffles (lines, orders, parts, customers)."""
    from wardline.plans.registry import CLINICAL
    from wardline.sources import fixtures as fx
    from wardline.sources.tables import stored_bytes
    line = spark.range(6_000).selectExpr(
        "cast(pmod(hash(id, 1), 300) as long) as l_orderkey", "cast(pmod(hash(id, 2), 40) as long) as l_partkey", "pmod(hash(id, 3), 5) as l_suppkey", "cast(pmod(hash(id, 4), 5) as int) as l_linenumber",
        "cast(pmod(hash(id, 5), 50) as double) as l_quantity", "cast(id as double) as l_extendedprice", "0.1D as l_discount", "if(id % 9 = 0, null, 0.2D) as l_tax",
        "if(id % 3 = 0, 'R', 'A') as l_returnflag", "if(id % 2 = 0, 'O', 'F') as l_linestatus", "if(id % 31 = 0, null, timestamp_seconds(800000000 + 86400 * pmod(hash(id, 6), 20))) as l_shipdate")
    line.write.parquet(f"{tmp_dir}/lineitem.parquet")
    spark.range(310).selectExpr("id % 305 as o_orderkey", "if(id % 50 = 0, null, id % 7) as o_custkey").write.parquet(f"{tmp_dir}/orders.parquet")
    spark.range(35).selectExpr("id as p_partkey", "concat('n', id) as p_name", "concat('b', id % 3) as p_brand", "concat('t', id % 4) as p_type").write.parquet(f"{tmp_dir}/part.parquet")
    assert stored_bytes(spark, tmp_dir, CLINICAL) > 0
    for parity, build in ((0, fx.conditions), (1, fx.medications)):
        o, p, li = (spark.read.parquet(f"{tmp_dir}/{t}.parquet") for t in ("orders", "part", "lineitem"))
        j = li.where(f"l_linenumber % 2 = {parity}").join(o, F.expr("l_orderkey = o_orderkey")).join(p, F.expr("l_partkey = p_partkey"))
        want = j.select("o_custkey", *fx._LINE_ORDER, "p_name", F.row_number().over(Window.partitionBy("o_custkey").orderBy(*fx._LINE_ORDER)).cast("long").alias("rec_offset"))
        got = fx._order_lines(spark, tmp_dir, parity).select(*want.columns)
        assert got.count() == want.count() > 1000 and got.exceptAll(want).count() == 0
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            assert build(spark, tmp_dir)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 5
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_by_time(spark):
    df = rows(spark, 50_000, 1)
    s = sequence_ops(df, "k", ["ts"], row_number="rn")
    w = Window.partitionBy("k").orderBy("ts")
    assert s.exceptAll(df.select("*", F.row_number().over(w).cast("long").alias("rn"))).count() == 0


def test_readmissions_with_a_patient_holding_a_third(spark):
    stays = spark.range(400_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), (F.col("id") % 5000).cast("string"))).alias("patient_id"),
        F.timestamp_seconds(F.hash("id").cast("long") % 100_000_000 + 1_500_000_000).alias("admit_time"),
        F.col("id").alias("encounter_id"), F.lit("payload").alias("p"))
    stays = stays.withColumn("discharge_time", F.col("admit_time") + F.expr("interval 3 days"))
    w = Window.partitionBy("patient_id").orderBy("admit_time", "encounter_id")
    want = stays.select("encounter_id", F.datediff(F.lead("admit_time").over(w), "discharge_time").alias("g"), (F.row_number().over(w) - 1).alias("n"))
    got = readmissions(stays).select("encounter_id", F.col("days_to_next_admit").alias("g"), F.col("prior_admission_count").alias("n"))
    assert got.count() == 400_000 and got.exceptAll(want).count() == 0


def test_a_hot_key_is_spread_over_tasks(spark):
    df = rows(spark, 30_000, 1 << 8)
    s = sequence_ops(df, "k", ["o", "tie"], row_number="rn")
    biggest = s.where("k = 'hot'").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert biggest < 10_000 * 0.6
