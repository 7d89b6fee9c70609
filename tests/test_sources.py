"""CSV exports, duplicates over several files, broken messages, landed tables."""

import os

import pytest
from pyspark.sql import functions as F

from wardline.operators.ingest import patients_dim
from wardline.session import checkpoint_dir
from wardline.sources import fixtures as fx
from wardline.sources.stream import RISK_MESSAGE, decode_json
from wardline.sources.tables import OBSERVATION_EXPORT, read_csv


def write(folder, name, lines):
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_csv_export_keeps_every_cell_a_string(spark, tmp_dir):
    write(tmp_dir, "obs.csv", [",".join(OBSERVATION_EXPORT), '2024-01-01T00:00:00Z,p1,e1,vital-signs,8867-4,"Heart, ""rate""",072,/min,numeric',
                               ",p2,,,8480-6,,n/a,,"])
    df = read_csv(spark, tmp_dir, ["VALUE", "PATIENT", "DATE", "DESCRIPTION"])
    assert {t for _, t in df.dtypes} == {"string"}
    assert [tuple(r) for r in df.orderBy("PATIENT").collect()] == [
        ("072", "p1", "2024-01-01T00:00:00Z", 'Heart, "rate"'), ("n/a", "p2", None, None)]
    with pytest.raises(Exception, match="NOPE"):
        read_csv(spark, tmp_dir, ["NOPE"]).collect()


def test_csv_stream_equals_batch(spark, tmp_dir):
    write(tmp_dir, "a.csv", [",".join(OBSERVATION_EXPORT), "d,p1,e,c,8867-4,x,72,/min,numeric"])
    write(tmp_dir, "b.csv", [",".join(OBSERVATION_EXPORT), "d,p2,e,c,8867-4,x,73,/min,numeric"])
    q = read_csv(spark, tmp_dir, OBSERVATION_EXPORT, streaming=True).writeStream.format("memory").queryName("obs_csv").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("obs_csv").exceptAll(read_csv(spark, tmp_dir, OBSERVATION_EXPORT)).count() == 0
    assert spark.table("obs_csv").count() == 2


@pytest.mark.parametrize("large", ["a", "b"])
def test_the_last_row_of_a_patient_wins_over_files_of_any_size(spark, tmp_dir, large):
    for name in "ab":
        filler = [f"{name}{i},1990-01-01,F" for i in range(5000 if name == large else 1)]
        write(tmp_dir, f"{name}.csv", ["Id,BIRTHDATE,GENDER", "dup,1,first-" + name, *filler, "dup,2,last-" + name])
    got = patients_dim(read_csv(spark, tmp_dir)).where("Id = 'dup'").first()
    assert got["GENDER"] == "last-b"


def test_broken_messages_are_marked(spark):
    rows = [(1, '{"patient_id": "p", "risk_level": "HIGH", "risk_pct": 1.5}'), (2, "not json"), (3, '{"patient_id": "p"'), (4, None), (5, ""), (6, "{}")]
    got = {r["k"]: r for r in decode_json(spark.createDataFrame(rows, "k int, value string"), RISK_MESSAGE).collect()}
    assert [got[k]["_corrupt"] for k in range(1, 5)] == [False, True, True, False] and not got[6]["_corrupt"]
    assert got[1]["risk_level"] == "HIGH" and got[2]["patient_id"] is None


def test_landed_tables_follow_code_and_input(spark, tmp_dir):
    code, data = os.path.join(tmp_dir, "code"), os.path.join(tmp_dir, "data")
    os.makedirs(code)
    os.makedirs(data)
    write(code, "rules.py", ["LIMIT = 1"])
    write(data, "one.csv", ["x", "1"])
    builds = []

    def land():
        fx.code_fingerprint.cache_clear()
        return fx.land(spark, data, "t", lambda: builds.append(1) or spark.read.csv(data, header=True), root=code).count()

    assert (land(), land(), len(builds)) == (1, 1, 1)
    write(data, "two.csv", ["x", "2"])
    assert (land(), len(builds)) == (2, 2)
    write(code, "rules.py", ["LIMIT = 2"])
    assert (land(), len(builds)) == (2, 3)
    fx.code_fingerprint.cache_clear()


def test_a_cluster_needs_a_shared_folder(spark):
    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Cluster())


def test_vital_codes_reach_the_csv_scan(spark, tmp_dir):
    from wardline.operators.ingest import vitals_only
    write(tmp_dir, "obs.csv", [",".join(OBSERVATION_EXPORT), "d,p1,e,c,8867-4,x,72,/min,numeric", "d,p1,e,c,other,x,72,/min,numeric"])
    df = vitals_only(read_csv(spark, tmp_dir, ["PATIENT", "CODE"]))
    assert df.count() == 1 and "PushedFilters: [In(CODE" in df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")) and F.col("CODE") is not None


def test_topic_sink_round_trip(spark, tmp_dir):
    from wardline.sources.stream import decode_topic, encode_topic, start_topic_sink
    rows = spark.createDataFrame([("p1", "HIGH", 1.5), ("p2", None, None)], "patient_id string, risk_level string, risk_pct double")
    rows.write.parquet(f"{tmp_dir}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_dir}/in")
    for _ in range(2):  # a restart writes nothing twice
        start_topic_sink(encode_topic(stream, "patient_id", rows.columns), "risk", f"{tmp_dir}/ckpt", path=tmp_dir).awaitTermination(60)
    back = decode_topic(spark.read.schema("key string, value string").json(f"{tmp_dir}/risk"), RISK_MESSAGE)
    got = {r["key"]: (r["patient_id"], r["risk_level"], r["risk_pct"], r["_corrupt"]) for r in back.collect()}
    assert back.count() == 2 and got == {"p1": ("p1", "HIGH", 1.5, False), "p2": ("p2", None, None, False)}
