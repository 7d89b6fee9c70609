"""Ordered per-key sequence operations that stay balanced when one key holds
a large share of the rows.

``Window.partitionBy(key)`` puts every row of a key into one task.  So keys are
counted first, in a job of its own: the rows of keys that have few are numbered by
one window, after a single shuffle.  In the rest a row's ``bucket`` is a pure function
of its first order column that never falls as the order rises (a week of a time, a
stretch of numbers), windows run per ``(key, bucket)``, and a table with one row per
``(key, bucket)`` of the hot keys adds what came before (counts, sums, the last value)
and what comes next (the first value).  A hot key is spread over as many tasks as it
has buckets.  Which keys are hot decides about tasks only, never about results.

Results equal the window functions ``row_number``, ``sum(...) ROWS UNBOUNDED
PRECEDING``, ``lag`` and ``lead`` over ``partitionBy(key).orderBy(order)``
(``order`` must be a total order within a key for lag/lead to be defined).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The widths of a bucket.
BUCKET_SECONDS = 7 * 86400
BUCKET_NUMBERS = 1 << 16
# A key of more rows is hot.
HOT_ROWS = 5_000


def order_bucket(df: DataFrame, column: str) -> Column:
    """A long that never falls as ``column`` rises; nulls, which come first, get
    the least one.  Other types than times and numbers are one bucket."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.DateType)):
        b = F.floor(F.unix_seconds(F.col(column).cast("timestamp")) / BUCKET_SECONDS)
    elif isinstance(kind, T.IntegralType):
        b = F.floor(F.col(column) / BUCKET_NUMBERS)
    else:
        b = F.lit(0)
    return F.coalesce(b.cast("long"), F.lit(-2**63).cast("long"))


def hot_keys(weigh: DataFrame, rows: int | None = None) -> DataFrame:
    """The keys (the only column of ``weigh``) that come more than ``rows`` times, as
    a local table: at most one for each ``rows`` rows.  They are counted here and now."""
    key = weigh.columns[0]
    found = weigh.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > (rows or HOT_ROWS)).select(F.col(key).alias("_hot")).collect()
    return weigh.sparkSession.createDataFrame(found, T.StructType([T.StructField("_hot", weigh.schema[0].dataType)]))


def sequence_ops(df: DataFrame, key: str, order: list[str], row_number: str | None = None,
                 running_sums: dict[str, str] | None = None, lags: dict[str, str] | None = None,
                 leads: dict[str, str] | None = None, bucket: Column | None = None, weigh: DataFrame | None = None) -> DataFrame:
    """Adds ``row_number`` (1-based), inclusive running sums, lags and leads
    per ``key`` in ``order``; output columns are named by the dict keys.
    ``bucket`` replaces the default bucket of the first order column, for all keys.
    ``weigh`` (one column) is counted by key instead of ``df`` to tell the hot keys,
    where something cheaper grows as ``df`` does."""
    sums, lags, leads = running_sums or {}, lags or {}, leads or {}
    types = {f.name: f.dataType for f in df.schema.fields}
    hot = hot_keys(df.select(key) if weigh is None else weigh) if bucket is None else None
    if hot is not None and hot.isEmpty():
        return _by_window(df, key, order, row_number, sums, lags, leads, types)
    base = df.withColumn("_bucket", order_bucket(df, order[0]) if bucket is None else bucket)
    if hot is not None:
        base = base.join(F.broadcast(hot.select("_hot", F.lit(True).alias("_is"))), F.col(key).eqNullSafe(F.col("_hot")), "left").drop("_hot")
        base = base.withColumn("_bucket", F.when(F.col("_is"), F.col("_bucket")).otherwise(F.lit(-2**63).cast("long")))
    # in a struct, nulls equal one another without another shuffle for the join
    base = base.withColumn("_own", F.struct(F.col(key).alias("k")))
    w = Window.partitionBy("_own", "_bucket").orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    local = base.withColumns(
        {"_rn": F.row_number().over(w).cast("long"), "_end": F.lead(F.lit(False), 1, True).over(w)}
        | {f"_sum_{o}": F.sum(c).over(upto) for o, c in sums.items()}
        | {f"_lag_{o}": F.lag(c).over(w) for o, c in lags.items()}
        | {f"_lead_{o}": F.lead(c).over(w) for o, c in leads.items()})
    # one row per (key, bucket), from partial aggregates; wrapped in a struct so
    # that a null value is told apart from no row
    rank = F.struct(*order)
    parts = (base if hot is None else base.where("_is")).groupBy("_own", "_bucket").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(f"_part_{o}") for o, c in sums.items()],
        *[F.max_by(F.struct(c), rank).alias(f"_last_{o}") for o, c in lags.items()],
        *[F.min_by(F.struct(c), rank).alias(f"_first_{o}") for o, c in leads.items()])
    runs = Window.partitionBy("_own").orderBy("_bucket")
    before = runs.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("_own").alias("_key"), F.col("_bucket").alias("_at"), F.sum("_n").over(before).alias("_before"),
        *[F.sum(f"_part_{o}").over(before).alias(f"_before_{o}") for o in sums],
        *[F.lag(f"_last_{o}").over(runs).getField(c).alias(f"_edge_{o}") for o, c in lags.items()],
        *[F.lead(f"_first_{o}").over(runs).getField(c).alias(f"_edge_{o}") for o, c in leads.items()])
    # keys that are not hot have no parts: they are one bucket
    j = local.join(parts, (F.col("_own") == F.col("_key")) & (F.col("_bucket") == F.col("_at")), "left")

    def total(o: str, c: str) -> Column:
        here, gone = F.col(f"_sum_{o}"), F.col(f"_before_{o}")
        return F.coalesce(here + gone, here, gone).cast(_sum_type(types[c])).alias(o)

    return j.select(
        *df.columns,
        *([(F.col("_rn") + F.coalesce("_before", F.lit(0))).cast("long").alias(row_number)] if row_number else []),
        *[total(o, c) for o, c in sums.items()],
        *[F.when(F.col("_rn") == 1, F.col(f"_edge_{o}")).otherwise(F.col(f"_lag_{o}")).alias(o) for o in lags],
        *[F.when(F.col("_end"), F.col(f"_edge_{o}")).otherwise(F.col(f"_lead_{o}")).alias(o) for o in leads])


def _sum_type(kind: T.DataType) -> str:
    return "long" if isinstance(kind, T.IntegralType) else "double"


def _by_window(df: DataFrame, key: str, order: list[str], row_number: str | None, sums: dict[str, str], lags: dict[str, str],
               leads: dict[str, str], types: dict[str, T.DataType]) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    return df.select(
        *df.columns,
        *([F.row_number().over(w).cast("long").alias(row_number)] if row_number else []),
        *[F.sum(c).over(upto).cast(_sum_type(types[c])).alias(o) for o, c in sums.items()],
        *[F.lag(c).over(w).alias(o) for o, c in lags.items()],
        *[F.lead(c).over(w).alias(o) for o, c in leads.items()])


def text_order(column: Column) -> Column:
    """A long that never falls as a text rises: its first seven bytes."""
    return F.conv(F.rpad(F.substring(F.hex(F.encode(column, "UTF-8")), 1, 14), 14, "0"), 16, 10).cast("long")


def spread(ids: DataFrame, column: str, buckets: int = 256) -> Column:
    """The bucket of a text among about equal shares of the rows of ``ids``: how many
    of the shares' bounds (a sketch of the first bytes) lie below it."""
    bounds = ids.agg(F.percentile_approx(text_order(F.col(column)), [i / buckets for i in range(1, buckets)], 10 * buckets)).scalar()
    at = text_order(F.col(column))
    # its place among the bounds; a subquery may not stand inside a lambda
    return F.array_position(F.sort_array(F.array_append(F.coalesce(bounds, F.array().cast("array<bigint>")), at)), at)


def global_rank(df: DataFrame, order: list[str], bucket: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with ``name``: the number of a row (from 1) in ``order`` over the whole
    table, as ``row_number`` over one window gives it, but numbered bucket by bucket.

    ``bucket``: longs that, compared one after the other, never fall as the order
    rises; ``spread`` splits the ties of a number, if equal numbers are ties, further
    by a text."""
    split = df.withColumn("_at", F.struct(*[b.alias(f"b{i}") for i, b in enumerate(bucket)]))
    local = split.withColumn("_rn", F.row_number().over(Window.partitionBy("_at").orderBy(*order)).cast("long"))
    # one row for each bucket, from the windows' own shuffle; only these meet in one task
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    parts = local.groupBy(F.col("_at").alias("_bucket")).agg(F.max("_rn").alias("_n")).select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return local.join(parts, F.col("_at").eqNullSafe(F.col("_bucket"))).select(*df.columns, (F.col("_rn") + F.col("_before")).alias(name))
