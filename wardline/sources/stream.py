"""Stream-shaped sources: typed stream declarations, connector semantics
(incremental poll, change-capture unwrap, topic routing, value-to-key) and
JSON decoding.  All are column expressions over a DataFrame, so the same code
runs on a Kafka/file ``readStream`` and on a static table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: declared stream schemas (all text fields VARCHAR) -------
VITALS_STREAM = T.StructType([
    T.StructField("patient_id", T.StringType()), T.StructField("encounter_id", T.StringType()),
    T.StructField("timestamp", T.StringType()), T.StructField("vital_type", T.StringType()),
    T.StructField("vital_description", T.StringType()), T.StructField("value", T.DoubleType()),
    T.StructField("units", T.StringType()), T.StructField("patient_age", T.IntegerType()),
    T.StructField("patient_gender", T.StringType()), T.StructField("source_system", T.StringType()),
])
CONDITIONS_STREAM = T.StructType([
    T.StructField("patient_id", T.StringType()), T.StructField("id", T.IntegerType()),
    T.StructField("condition_code", T.StringType()), T.StructField("condition_name", T.StringType()),
    T.StructField("diagnosed_date", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("severity", T.StringType()), T.StructField("notes", T.StringType()),
    T.StructField("created_at", T.StringType()), T.StructField("updated_at", T.StringType()),
])
MEDICATIONS_STREAM = T.StructType([
    T.StructField("patient_id", T.StringType()), T.StructField("id", T.IntegerType()),
    T.StructField("medication_name", T.StringType()), T.StructField("dosage", T.StringType()),
    T.StructField("frequency", T.StringType()), T.StructField("route", T.StringType()),
    T.StructField("prescriber", T.StringType()), T.StructField("start_date", T.StringType()),
    T.StructField("end_date", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("notes", T.StringType()), T.StructField("created_at", T.StringType()),
    T.StructField("updated_at", T.StringType()),
])
RISK_MESSAGE = T.StructType([
    T.StructField("patient_id", T.StringType()), T.StructField("risk_level", T.StringType()),
    T.StructField("risk_pct", T.DoubleType()), T.StructField("readmit_probability", T.DoubleType()),
    T.StructField("source", T.StringType()),
])


def declare_stream(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ("rec_offset",)) -> DataFrame:
    """Project a record DataFrame onto a declared stream schema: present
    fields are cast, absent ones are typed nulls; bookkeeping columns
    (offsets) are kept."""
    cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    return df.select(*cols, *[c for c in keep if c in df.columns])


def incremental_poll(table: DataFrame, ts_col: str, hwm, overlap_seconds: int = 0) -> DataFrame:
    """Timestamp-mode poll: rows with ``ts_col > hwm`` (strict, as the
    connector does; ``overlap_seconds`` re-reads a margin so ties at the mark
    are not lost, at the cost of duplicates the upsert absorbs).  The filter
    is a plain comparison, so it reaches the scan / JDBC source as a pushed
    predicate."""
    mark = F.lit(hwm).cast("timestamp")
    if overlap_seconds:
        mark = mark - F.make_dt_interval(secs=F.lit(overlap_seconds))
    return table.where(F.col(ts_col) > mark)


def next_hwm(polled: DataFrame, ts_col: str) -> DataFrame:
    """The high-water mark after a poll (one-row partial aggregate)."""
    return polled.agg(F.max(ts_col).alias("hwm"))


def change_envelope(log: DataFrame, op_col: str, ts_col: str, fields: list[str]) -> DataFrame:
    """Encode a change log as change-capture JSON envelopes
    ``{op, ts_ms, before, after}`` (after is null for deletes, before is null
    for creates)."""
    row = F.struct(*[F.col(c) for c in fields])
    op = F.col(op_col)
    env = F.struct(
        op.alias("op"),
        F.unix_millis(F.col(ts_col)).alias("ts_ms"),
        F.when(op != "c", row).alias("before"),
        F.when(op != "d", row).alias("after"),
    )
    return log.select("rec_offset", F.to_json(env).alias("value"))


def cdc_unwrap(envelopes: DataFrame, row_schema: T.StructType, value_col: str = "value") -> DataFrame:
    """Flatten change-capture envelopes: new row state (the old state for
    deletes), plus ``__op``, ``__source_ts_ms`` and ``__deleted``.  A null
    value (tombstone) is kept as a row with null fields."""
    env_schema = T.StructType([
        T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType()),
        T.StructField("before", row_schema), T.StructField("after", row_schema),
    ])
    e = F.from_json(F.col(value_col), env_schema)
    state = F.coalesce(e["after"], e["before"])
    keep = [c for c in envelopes.columns if c != value_col]
    out = envelopes.select(*keep, e.alias("_e"), state.alias("_s"))
    return out.select(*keep, *[F.col("_s")[f.name].alias(f.name) for f in row_schema.fields],
                      F.col("_e.op").alias("__op"), F.col("_e.ts_ms").alias("__source_ts_ms"),
                      F.when(F.col("_e.op").isNotNull(), (F.col("_e.op") == "d").cast("string"))
                      .alias("__deleted"))


def topic_route(df: DataFrame, topic_col: str, regex: str, replacement: str) -> DataFrame:
    """Regex topic rename: applies only when the regex matches the whole
    topic name (Java ``Matcher.matches``), else the name is kept."""
    full = f"^(?:{regex})$"
    t = F.col(topic_col)
    return df.withColumn(topic_col, F.when(t.rlike(full), F.regexp_replace(t, full, replacement)).otherwise(t))


def value_to_key(df: DataFrame, field: str, key_col: str = "key") -> DataFrame:
    return df.withColumn(key_col, F.col(field).cast("string"))


def decode_json(df: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """Permissive JSON decode; unparseable messages are marked ``_corrupt`` (the
    error branch) instead of failing the batch.  A null message is not corrupt."""
    bad = "_corrupt_record"
    marked = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    parsed = F.from_json(F.col(value_col), marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    keep = [c for c in df.columns if c != value_col]
    out = df.select(*keep, F.col(value_col), parsed.alias("_p"))
    return out.select(*keep, *[F.col("_p")[f.name].alias(f.name) for f in schema.fields],
                      (F.col("_p")[bad].isNotNull() | (F.col("_p").isNull() & F.col(value_col).isNotNull())).alias("_corrupt"))


def stream_source(spark: SparkSession, kind: str, schema: T.StructType | None = None, **opts) -> DataFrame:
    """One entry point for streaming inputs.

    ``kind="kafka"`` subscribes to topics (``subscribe``, ``kafka.bootstrap.servers``,
    ``startingOffsets="earliest"``), the broker offsets serving as the
    consumer position via the query checkpoint.  ``kind`` ``parquet`` /
    ``json`` / ``csv`` read a file folder as a stream (``maxFilesPerTrigger``
    bounds a micro-batch) with a declared schema, no inference.
    """
    if kind == "kafka":
        r = spark.readStream.format("kafka").option("startingOffsets", "earliest")
        for k, v in opts.items():
            r = r.option(k, v)
        return r.load()
    path = opts.pop("path")
    r = spark.readStream.format(kind)
    if schema is not None:
        r = r.schema(schema)
    for k, v in opts.items():
        r = r.option(k, v)
    return r.load(path)


def encode_topic(df: DataFrame, key_col: str, columns: list[str], fmt: str = "json", avro_schema: str | None = None) -> DataFrame:
    """Rows as keyed messages ``(key, value)``: ``value`` is the struct of
    ``columns`` as JSON text (null fields kept) or as Avro."""
    body = F.struct(*columns)
    if fmt == "avro":
        from pyspark.sql.avro.functions import to_avro  # needs the spark-avro package on the cluster
        value = to_avro(body, avro_schema) if avro_schema else to_avro(body)
    else:
        value = F.to_json(body, {"ignoreNullFields": "false"})
    return df.select(F.col(key_col).cast("string").alias("key"), value.alias("value"))


def strip_registry_header(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Registry-framed messages: a zero byte, four bytes with the number of the
    schema, then the body.  ``value_col`` becomes the body, ``schema_id`` the number;
    both are null for a message that is not framed so (too short, another first
    byte)."""
    v = F.col(value_col)
    framed = (F.octet_length(v) >= 5) & (F.hex(F.substring(v, 1, 1)) == "00")
    number = F.conv(F.hex(F.substring(v, 2, 4)), 16, 10).cast("long")
    return df.withColumns({value_col: F.when(framed, F.substring(v, 6, 2**31 - 1)), "schema_id": F.when(framed, number)})


def decode_registry_avro(df: DataFrame, schemas: dict[int, str], reader: str, value_col: str = "value", decode=None) -> DataFrame:
    """Registry-framed Avro messages to columns of the ``reader`` schema.  Each body
    is decoded with the schema that wrote it, by its number; messages of an unknown
    number, unframed ones and undecodable ones get ``_corrupt``.  ``decode(column,
    writer, reader)`` stands for ``from_avro`` (needs the spark-avro package)."""
    if decode is None:
        from pyspark.sql.avro.functions import from_avro

        def decode(column, writer, wanted):
            return from_avro(column, wanted, {"mode": "PERMISSIVE", "avroSchema": writer})
    framed = strip_registry_header(df.withColumn("_some", F.col(value_col).isNotNull()), value_col)
    branches = [F.when(F.col("schema_id") == number, decode(F.col(value_col), writer, reader)) for number, writer in sorted(schemas.items())]
    parsed = framed.withColumn("_p", F.coalesce(*branches))
    keep = [c for c in df.columns if c != value_col]
    return parsed.select(*keep, "schema_id", "_p.*", (F.col("_p").isNull() & F.col("_some")).alias("_corrupt"))


def decode_topic(df: DataFrame, schema: T.StructType | str, fmt: str = "json", value_col: str = "value") -> DataFrame:
    """Messages back to columns: JSON by ``decode_json``, Avro by its reader
    schema (a JSON string; undecodable messages give null columns)."""
    if fmt == "avro":
        from pyspark.sql.avro.functions import from_avro
        keep = [c for c in df.columns if c != value_col]
        return df.select(*keep, from_avro(F.col(value_col), schema, {"mode": "PERMISSIVE"}).alias("_p")).select(*keep, "_p.*")
    return decode_json(df.withColumn(value_col, F.col(value_col).cast("string")), schema, value_col)


def start_topic_sink(messages: DataFrame, topic: str, checkpoint: str, servers: str | None = None, path: str | None = None):
    """Write keyed messages to a topic as they come: to a broker if ``servers`` is
    given, else as JSON files under ``path`` (a topic's stand-in).  The query's
    checkpoint holds the positions, so a restart goes on where it ended."""
    w = messages.writeStream.option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
    if servers:
        return w.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).start()
    return w.format("json").option("path", f"{path}/{topic}").start()
