"""The live patient document: three streams, one stateful operator.

The streams are tagged and united; each task first folds its own rows into
segments (runs of a patient's updates without a gap beyond the time to live), of
bounded size for any number of readings, so that a very active patient sends one row
from each task to its state.  The state of a patient is the list of segments that may
still grow, newest last; the newest is the document.  A timer in event time ends a
document that got no update for the time to live.

Documents equal ``operators.context.context_document`` over what has arrived: a
segment is never cut by another one's rows, so segments join exactly where a batch
over all rows finds no gap.  Rows older than the watermark are late and are left out;
segments that no later row can reach are dropped from the state.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wardline import rules
from wardline.operators import context as ctx
from wardline.streaming.keyed import KeyedTable

#: Fields of a list entry, by source; they travel in the columns e0 to e3.
ENTRY = {"conditions": ("condition_name", ("condition_code", "status", "severity")),
         "medications": ("medication_name", ("dosage", "frequency", "route", "status"))}
KINDS = ("readings", "conditions", "medications")

UPDATE = "patient_id string, t timestamp, kind int, rec_offset long, name string, value double, units string, stamp string, age int, gender string, e0 string, e1 string, e2 string, e3 string"


def tagged(readings: DataFrame, conditions: DataFrame, medications: DataFrame) -> list[DataFrame]:
    """The updates of the three sources in one shape (``UPDATE``); rows without a
    patient or a time update nothing."""
    schema = T._parse_datatype_string(UPDATE)

    def of(kind: int, df: DataFrame, time: str, **columns: Column) -> DataFrame:
        own = {"patient_id": F.col(ctx.KEY), "t": F.col(time), "kind": F.lit(kind), "rec_offset": F.col("rec_offset")} | columns
        out = df.select(*[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
        return out.where((F.coalesce("patient_id", F.lit("")) != "") & F.col("t").isNotNull())

    def entries(kind: int, df: DataFrame) -> DataFrame:
        name, fields = ENTRY[KINDS[kind]]
        return of(kind, df, "updated_at", name=F.col(name), **{f"e{i}": F.col(c) for i, c in enumerate(fields)})

    vitals = of(0, readings, "ingest_ts", name=F.col("vital"), value=F.col("value"), units=F.col("units"), stamp=F.col("timestamp"),
                age=F.col("patient_age"), gender=F.col("patient_gender"))
    return [vitals, entries(1, conditions), entries(2, medications)]


# ----------------------------------------------------------------- segments
# A segment: s, e (first and last time, in microseconds), p [offset, age, gender] of the newest
# reading, v {vital: newest readings [offset, value, units, stamp], oldest first},
# k [conditions, medications], each {name: [first offset, last offset, fields]}.


def _newer(a: list | None, b: list | None) -> list | None:
    return b if a is None or (b is not None and b[0] > a[0]) else a


def joined(a: dict, b: dict, n: int) -> dict:
    """Two segments of a patient as one; the order doesn't matter, nor do repeats."""
    v = dict(a["v"])
    for name, more in b["v"].items():
        v[name] = sorted({r[0]: r for r in v.get(name, []) + more}.values())[-n:] if name in v else more
    k = []
    for x, y in zip(a["k"], b["k"], strict=True):
        both = dict(x)
        for name, (first, last, fields) in y.items():
            had = both.get(name)
            both[name] = [first, last, fields] if had is None else [min(had[0], first), *max(had[1:], [last, fields], key=lambda z: z[0])]
        k.append(both)
    return {"s": min(a["s"], b["s"]), "e": max(a["e"], b["e"]), "p": _newer(a["p"], b["p"]), "v": v, "k": k}


def united(segments: list[dict], ttl: int, n: int) -> list[dict]:
    """Segments in order, joined where no gap exceeds ``ttl`` microseconds."""
    out: list[dict] = []
    for s in sorted(segments, key=lambda x: (x["s"], x["e"])):
        if out and s["s"] - out[-1]["e"] <= ttl:
            out[-1] = joined(out[-1], s, n)
        else:
            out.append(s)
    return out


#: Stands for a missing name in a segment's maps.
NO_NAME = "\0"


def _of_row(us: int, kind: int, offset: int, name: str | None, value: float | None, units: str | None, stamp: str | None, age: int | None, gender: str | None, entry: list) -> dict:
    """The segment of one update."""
    seg: dict = {"s": us, "e": us, "p": None, "v": {}, "k": [{}, {}]}
    if kind == 0:
        seg["p"] = [offset, age, gender]
        seg["v"][name] = [[offset, value, units, stamp]]
    else:
        seg["k"][kind - 1][NO_NAME if name is None else name] = [offset, offset, entry[:len(ENTRY[KINDS[kind]][1])]]
    return seg


def segments(updates: DataFrame, ttl_seconds: int = rules.CONTEXT_TTL_SECONDS, n: int = rules.HISTORY_LEN) -> DataFrame:
    """``(patient_id, t, segment)``: updates folded within each task, by batches of
    rows; ``t`` is a segment's last time."""
    ttl = ttl_seconds * 1_000_000

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.set_column(1, "t", batch.column(1).cast(pa.timestamp("us", "UTC")).cast(pa.int64()))
            own: dict[str, list[dict]] = {}
            for patient, *row, e0, e1, e2, e3 in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                held = own.setdefault(patient, [])
                held.append(_of_row(*row, [e0, e1, e2, e3]))
                if len(held) == 64:
                    own[patient] = united(held, ttl, n)
            out = [(patient, seg["e"], json.dumps(seg)) for patient, held in own.items() for seg in united(held, ttl, n)]
            ids, ends, texts = (list(x) for x in zip(*out, strict=True)) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(ends, pa.int64()).cast(pa.timestamp("us", "UTC")), pa.array(texts, pa.string())], names=["patient_id", "t", "segment"])

    return updates.mapInArrow(fold, "patient_id string, t timestamp, segment string")


# ------------------------------------------------------------------- state

STATE = "segments string"
OUTPUT = "patient_id string, started_at long, last_update long, expired boolean, segment string"


def fold_documents(sources: list[DataFrame], delay: str, ttl_seconds: int = rules.CONTEXT_TTL_SECONDS, n: int = rules.HISTORY_LEN) -> DataFrame:
    """The stateful operator over the streams of ``tagged`` updates: a row with the
    whole document for each patient that a micro-batch touches, and one with
    ``expired`` for each document that ends.  Each source has a watermark of its own,
    ``delay`` behind its newest row; the slowest source holds the common one back."""
    ttl = ttl_seconds * 1_000_000

    def row(key: tuple, seg: dict, expired: bool) -> pd.DataFrame:
        return pd.DataFrame({"patient_id": [key[0]], "started_at": [seg["s"]], "last_update": [seg["e"]], "expired": [expired], "segment": [json.dumps(seg)]})

    def fold(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs() * 1000
        have = json.loads(state.get[0]) if state.exists else []
        more = [json.loads(s) for part in parts for s in part["segment"]]
        have = united(have + more, ttl, n)
        # no row on or after the watermark reaches what ended longer ago
        have = [x for x in have[:-1] if x["e"] + ttl >= now] + have[-1:]
        if not have:
            return
        newest = have[-1]
        if newest["e"] + ttl < now:
            state.remove()
            yield row(key, newest, True)
            return
        state.update((json.dumps(have),))
        state.setTimeoutTimestamp(max((newest["e"] + ttl) // 1000, now // 1000 + 1))
        if more:
            yield row(key, newest, False)

    marked = [segments(x, ttl_seconds, n).withWatermark("t", delay) for x in sources]
    return reduce(DataFrame.unionByName, marked).groupBy("patient_id").applyInPandasWithState(fold, OUTPUT, STATE, "update", GroupStateTimeout.EventTimeTimeout)


def as_documents(rows: DataFrame) -> DataFrame:
    """Stored rows of ``fold_documents`` as nested documents, with the columns of
    ``context_document`` (empty maps and lists stay null, as there)."""
    # lists of a segment are read by place, their parts as text
    seg = F.from_json("segment", T._parse_datatype_string("p string, v string, k array<string>"))
    p = F.from_json(seg["p"], T.ArrayType(T.StringType()))
    vitals = F.from_json(seg["v"], T.MapType(T.StringType(), T.ArrayType(T.ArrayType(T.StringType()))))
    reading = lambda r: F.struct(F.get(r, F.lit(1)).cast("double").alias("value"), F.get(r, F.lit(3)).alias("timestamp"))

    def current(_, history: Column) -> Column:
        first, last = F.get(history, F.lit(0)), F.get(history, F.size(history) - 1)
        old, new = F.get(first, F.lit(1)).cast("double"), F.get(last, F.lit(1)).cast("double")
        trend = F.when(F.size(history) >= 2, F.struct(*[c.alias(a) for a, c in ctx.trend_of(old, new).items()], F.size(history).cast("long").alias("readings")))
        return F.struct(new.alias("value"), F.get(last, F.lit(2)).alias("units"), F.get(last, F.lit(3)).alias("timestamp"), trend.alias("trend"))

    def entries(at: int) -> Column:
        fields = ENTRY[KINDS[at + 1]][1]
        names = [{"condition_code": "code"}.get(f, f) for f in fields]
        own = F.map_entries(F.from_json(F.get(seg["k"], F.lit(at)), T.MapType(T.StringType(), T.ArrayType(T.StringType()))))
        own = F.transform(own, lambda x: F.struct(F.get(x["value"], F.lit(0)).cast("long").alias("at"), F.when(x["key"] != NO_NAME, x["key"]).alias("name"),
                                                  F.from_json(F.get(x["value"], F.lit(2)), T.ArrayType(T.StringType())).alias("f")))
        listed = F.transform(F.array_sort(own), lambda x: F.struct(x["name"].alias("name"), *[F.get(x["f"], F.lit(i)).alias(c) for i, c in enumerate(names)]))
        return F.when(F.size(listed) > 0, listed)

    some = F.size(F.map_keys(vitals)) > 0
    return rows.select(
        "patient_id", F.coalesce(F.get(p, F.lit(1)).cast("int"), F.lit(0)).alias("patient_age"), F.coalesce(F.get(p, F.lit(2)), F.lit("")).alias("patient_gender"),
        F.when(some, F.transform_values(vitals, current)).alias("vitals"),
        F.when(some, F.transform_values(F.transform_keys(vitals, lambda k, _: F.concat(k, F.lit("_history"))), lambda _, h: F.transform(h, reading))).alias("vitals_history"),
        entries(0).alias("conditions"), entries(1).alias("medications"),
        F.timestamp_micros("started_at").alias("started_at"), F.timestamp_micros("last_update").alias("last_update"))


def documents_table(spark, path: str) -> KeyedTable:
    return KeyedTable(spark, path, ["patient_id"], gone="expired")


def start_documents(readings: DataFrame, conditions: DataFrame, medications: DataFrame, path: str, checkpoint: str, delay: str = "24 hours",
                    trigger: dict | None = None, ttl_seconds: int = rules.CONTEXT_TTL_SECONDS, compact_every: int = 50):
    """Run the live documents of three streams into a keyed table at ``path``
    (``documents_table``); a replayed micro-batch overwrites its own version."""
    out = fold_documents(tagged(readings, conditions, medications), delay, ttl_seconds)

    def batch(df: DataFrame, batch_id: int) -> None:
        table = documents_table(df.sparkSession, path)
        if batch_id and batch_id % compact_every == 0:
            table.compact(batch_id - 1)
        table.write(df, batch_id)

    return (out.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def live_documents(spark, path: str) -> DataFrame | None:
    """The documents that have not ended, as of the last micro-batch."""
    rows = documents_table(spark, path).read()
    return None if rows is None else as_documents(rows)
