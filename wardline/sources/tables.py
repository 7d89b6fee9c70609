"""Readers for the parquet tables a deployment points wardline at."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Plain parquet scan; filters and projections applied later are pushed
    into this scan by Catalyst (``PushedFilters`` / pruned ``ReadSchema``)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def stored_bytes(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> int:
    """Stored size of the tables ``names`` that are there."""
    conf, total = spark._jsc.hadoopConfiguration(), 0
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(sf_dir, f"{name}.parquet"))
        fs = path.getFileSystem(conf)
        total += fs.getContentSummary(path).getLength() if fs.exists(path) else 0
    return total


# --- fixed values: header columns of the exports ---------------------------
PATIENT_EXPORT = "Id BIRTHDATE GENDER RACE ETHNICITY MARITAL FIRST LAST CITY STATE".split()
OBSERVATION_EXPORT = "DATE PATIENT ENCOUNTER CATEGORY CODE DESCRIPTION VALUE UNITS TYPE".split()


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, streaming: bool = False, **options) -> DataFrame:
    """A CSV export with a header, all columns as strings: what a cell holds is
    judged by the validators, never by inference.  ``columns`` are looked up by
    their header names whatever their order (a missing one is an error); without
    them the header decides.  ``streaming`` reads the files of a folder as they
    come, with ``columns`` as the declared schema in file order."""
    reader = (spark.readStream if streaming else spark.read).options(header=True, inferSchema=False, multiLine=False, escape='"', **options)
    if streaming:
        return reader.schema(", ".join(f"`{c}` string" for c in columns or OBSERVATION_EXPORT)).csv(path)
    df = reader.csv(path)
    return df.select(*columns) if columns else df
