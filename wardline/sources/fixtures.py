"""Input streams and tables of the clinical pipeline, projected from the
driver tables (see FIXTURES.md).  Each projection is a lazy DataFrame; the
parquet scans underneath keep column pruning and filter pushdown.

The same projections exist as DuckDB SQL in ``wardline.plans.fixture_sql``
for the oracle check.
"""

from __future__ import annotations

import functools
import hashlib
import threading
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline import rules
from wardline.functions.scalar import patient_key
from wardline.session import scratch_path
from wardline.sources.tables import read_table

# --- fixed values: fixture code book (k % 8 -> LOINC code, units, value rule)
FIXTURE_CODES = [
    # k%8, code,      description,                units,    VALUE text rule (v = value as decimal(10,2))
    (0, "8867-4",  "Heart Rate",               "/min",   "15 + v % 150"),
    (1, "8480-6",  "Systolic Blood Pressure",  "mm[Hg]", "40 + v * 1.5"),
    (2, "8462-4",  "Diastolic Blood Pressure", "mm[Hg]", "15 + v"),
    (3, "2708-6",  "Oxygen Saturation",        "%",      "101 - v * 0.25"),
    (4, "9279-1",  "Respiratory Rate",         "/min",   "2 + v * 0.35"),
    (5, "8310-5",  "Body Temperature",         "degF",   "95 + v * 0.1"),
    (6, "29463-7", "Body Weight",              "kg",     "v"),
    (7, "29463-7", "Body Weight",              "kg",     "v"),
]
MED_FREQUENCY = "daily"
MED_ROUTE = "oral"
AS_OF_EVENTS = "2024-01-31 00:00:00"
AS_OF_ORDERS = "2001-11-05 00:00:00"
PATIENT_GAP_MOD = 17  # customers with key % 17 == 16 have no demographics row


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("int")


def patients(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer")
    return c.where(F.col("c_custkey") % PATIENT_GAP_MOD != PATIENT_GAP_MOD - 1).select(
        patient_key(F.col("c_custkey")).alias("Id"),
        F.date_format(F.date_add(F.lit("1930-01-01").cast("date"),
                                 (F.col("c_custkey") * 37 % 29000).cast("int")), "yyyy-MM-dd").alias("BIRTHDATE"),
        F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("GENDER"),
        F.col("c_mktsegment").alias("MARITAL"),
    )


def observations(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "events")
    eid = F.col("event_id")
    k8 = (_k() % 8) + 1  # 1-based index into the code book

    def pick(i: int) -> F.Column:
        return F.element_at(F.array(*[F.lit(row[i]) for row in FIXTURE_CODES]), k8)

    v = F.col("value").cast("decimal(10,2)")
    # VALUE rules of the code book as offset + factor * v (k%8 == 0: 15 + v % 150)
    offs = F.expr("array(15, 40, 15, 101, 2, 95, 0, 0)")
    facs = F.expr("array(0, 1.5, 1, -0.25, 0.35, 0.1, 1, 1)")
    lin = F.element_at(offs, k8) + F.element_at(facs, k8) * v
    num = F.when(k8 == 1, F.lit(15) + v % 150).otherwise(lin).cast("decimal(10,2)").cast("string")
    value = (F.when(eid % 101 == 0, F.lit("")).when(eid % 103 == 0, F.lit("N/A"))
             .when(eid % 107 == 0, F.lit("nan")).otherwise(num))
    date = (F.when(eid % 109 == 0, F.lit("")).when(eid % 113 == 0, F.lit("not-a-date"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    source = (F.when(F.col("event_type") == "click", "csv_lab_export")
              .when(F.col("event_type") == "view", "jdbc_postgres").otherwise("debezium_mysql"))
    return e.select(
        eid.alias("rec_offset"),
        F.col("ts").cast("timestamp").alias("ingest_ts"),
        patient_key(F.col("user_id")).alias("PATIENT"),
        F.concat(F.lit("E"), eid.cast("string")).alias("ENCOUNTER"),
        date.alias("DATE"),
        pick(1).alias("CODE"),
        pick(2).alias("DESCRIPTION"),
        value.alias("VALUE"),
        pick(3).alias("UNITS"),
        source.alias("source_system"),
    )


_LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
               "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def _order_lines(spark: SparkSession, d: str, parity: int) -> DataFrame:
    li = read_table(spark, d, "lineitem").where(F.col("l_linenumber") % 2 == parity)
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey")
    p = read_table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    # an order's lines in order stand for all columns that only break ties, so that
    # these take part in one shuffle and not in three
    rest = [c for c in _LINE_ORDER if c not in ("l_shipdate", "l_orderkey")]
    line = Window.partitionBy("l_orderkey").orderBy("l_shipdate", *rest)
    j = j.withColumn("_line", F.row_number().over(line)).join(p, li.l_partkey == p.p_partkey)
    # rec_offset stands for the topic offset: arrival order within the patient
    # (balanced even when one customer holds most orders, see sequence_ops)
    from wardline.operators.sequence import sequence_ops
    return sequence_ops(j, "o_custkey", ["l_shipdate", "l_orderkey", "_line"], row_number="rec_offset", weigh=o.select("o_custkey"))


def conditions(spark: SparkSession, d: str) -> DataFrame:
    j = _order_lines(spark, d, 0)
    return j.select(
        "rec_offset",
        patient_key(F.col("o_custkey")).alias("patient_id"),
        F.col("p_type").alias("condition_code"),
        F.concat_ws(" ", "p_type", "p_brand").alias("condition_name"),
        F.when(F.col("l_linestatus") == "O", "active").otherwise("resolved").alias("status"),
        F.when(F.col("l_returnflag") == "R", "severe").when(F.col("l_returnflag") == "A", "moderate")
        .otherwise("mild").alias("severity"),
        F.col("l_shipdate").cast("timestamp").alias("updated_at"),
    )


def medications(spark: SparkSession, d: str) -> DataFrame:
    j = _order_lines(spark, d, 1)
    pm = F.col("l_partkey") % 20
    return j.select(
        "rec_offset",
        patient_key(F.col("o_custkey")).alias("patient_id"),
        F.col("p_name").alias("medication_name"),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("mg")).alias("dosage"),
        F.lit(MED_FREQUENCY).alias("frequency"),
        F.lit(MED_ROUTE).alias("route"),
        F.lit("active").alias("status"),
        F.when(pm == 0, "d").when(pm <= 5, "u").otherwise("c").alias("op"),
        F.col("l_shipdate").cast("timestamp").alias("updated_at"),
    )


def stays(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    k = F.col("o_orderkey")
    admit = F.col("o_orderdate").cast("timestamp")
    return o.select(
        k.alias("encounter_id"),
        patient_key(F.col("o_custkey")).alias("patient_id"),
        admit.alias("admit_time"),
        (admit + F.make_dt_interval((k % 7 + 1).cast("int"))).alias("discharge_time"),
        F.col("o_totalprice").alias("total_claim_cost"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).when(k % 11 == 0, F.lit("  "))
        .otherwise(F.col("o_orderpriority")).alias("reasondescription"),
    )


def status_events(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "events")
    k = _k()
    return e.select(
        F.col("event_type").alias("component"),
        (F.col("user_id") % 3).cast("int").alias("task_id"),
        F.when(k < 5, "FAILED").when(k < 10, "PAUSED").otherwise("RUNNING").alias("state"),
        F.col("event_id").alias("rec_offset"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def topic_log(spark: SparkSession, d: str) -> DataFrame:
    """A keyed, partitioned message log: one topic per event type."""
    from wardline.operators.sequence import sequence_ops
    e = read_table(spark, d, "events").withColumn(
        "_tp", F.concat_ws("|", "event_type", (F.col("user_id") % 6).cast("string")))
    # a topic partition is a very large group: the offsets are numbered with
    # the bucketed sequence primitive, not a one-task window
    e = sequence_ops(e, "_tp", ["event_id"], row_number="_rn")
    return e.select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 6).cast("int").alias("partition"),
        (F.col("_rn") - 1).cast("long").alias("offset"),
        patient_key(F.col("user_id")).alias("key"),
        F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("string")).otherwise(F.col("props")).alias("value"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def schema_versions(spark: SparkSession, d: str) -> DataFrame:
    p = read_table(spark, d, "part")
    return p.select(F.col("p_brand").alias("subject"), F.col("p_size").alias("version"),
                    F.col("p_partkey").alias("id"), F.lit("AVRO").alias("schema_type"))


# --- landed tables ---------------------------------------------------------
# The projections above stand in for data that a deployment has already
# landed (CSV exports, topic dumps, database extracts).  ``landed`` writes a
# projection once as a parquet table in the shared checkpoint folder and
# reads it back, so queries scan stored columns (with filter pushdown and
# column pruning) instead of re-deriving them from the driver tables in every
# plan.  The folder name carries a hash of this library's code (a table may
# depend on any of its modules) and of the input files, so a changed definition
# or input lands a new table.
_LOCK = threading.RLock()


@functools.cache
def code_fingerprint(root: str) -> str:
    """Hash of the library's modules (the corpus operators stand apart)."""
    h = hashlib.sha1()
    for f in sorted(Path(root).rglob("*.py")):
        name = f.relative_to(root).as_posix()
        if not name.startswith("llm/"):
            h.update(name.encode() + b"\0" + f.read_bytes())
    return h.hexdigest()[:12]


def input_fingerprint(spark: SparkSession, d: str) -> str:
    """Hash of the names, sizes and times of all files under ``d``, as Spark's
    file system for that path lists them."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(d)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    found = []
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath().toString()}:{f.getLen()}:{f.getModificationTime()}")
    return hashlib.sha1("\n".join(sorted(found)).encode()).hexdigest()[:12]


def landed(spark: SparkSession, d: str, name: str) -> DataFrame:
    return land(spark, d, name, lambda: globals()[name](spark, d))


def stored_path(spark: SparkSession, d: str, name: str, root: str | None = None) -> str:
    """The folder of what is built once from the inputs ``d`` by this code."""
    root = root or str(Path(__file__).resolve().parent.parent)
    return scratch_path(spark, f"landed/{name}-{code_fingerprint(root)}-{input_fingerprint(spark, d)}")


def land(spark: SparkSession, d: str, name: str, build, root: str | None = None) -> DataFrame:
    """Write ``build()`` once as a parquet table under the checkpoint folder and
    read it back.  Only a completed write counts: the table is written aside and
    renamed, so of two writers one wins and a write cut short is redone."""
    path = stored_path(spark, d, name, root)
    with _LOCK:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(target):
            aside = f"{path}.{uuid.uuid4().hex}"
            build().write.parquet(aside)
            if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(aside), target):
                fs.delete(spark._jvm.org.apache.hadoop.fs.Path(aside), True)
        return spark.read.parquet(path)
