"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every wardline job relies on.  AQE re-plans joins and aggregates
# from runtime sizes (broadcast conversion, partition coalescing, skew-join
# splitting), which is what keeps the patient-keyed plans healthy when one
# patient or source holds a large share of the rows.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    # a task's rows take several times their shuffled size in sorts and hash tables
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # stages whose generated method would exceed what the JIT compiles fall
    # back to per-operator code instead of running interpreted bytecode
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "wardline", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k in ("spark.sql.session.timeZone",):
        spark.conf.set(k, conf[k])
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings wardline relies on to a session built
    elsewhere (UTC session zone, AQE with skew handling, codegen fallback)."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            try:
                if spark.conf.get(k, None) != v:
                    spark.conf.set(k, v)
            except Exception:  # noqa: BLE001 - static conf in this deployment
                pass
    return spark


# Bytes of stored input for one partition of a shuffle, before AQE coalesces them.
INPUT_PER_PARTITION = 8 << 20


def partitions_for(input_bytes: int, least: int) -> int:
    """Partitions of a shuffle, so that one holds no more rows as the input grows."""
    return max(least, -(-input_bytes // INPUT_PER_PARTITION))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage and is only read
    here; without it this raises, for a machine's own folder would lose rows
    unseen.  In local mode (tests) a scratch folder is created and registered,
    so that ``DataFrame.checkpoint()``, streaming checkpoints and landed tables
    have a home.  The RDD checkpoint folder is registered once.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="wardline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), name)
