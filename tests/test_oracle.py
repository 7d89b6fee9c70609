"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01 with tools/oracle_check.py semantics)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from tools.oracle_check import rows  # noqa: E402
from wardline.plans import registry  # noqa: E402
from wardline.sources.tables import DRIVER_TABLES  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

E.queries()
SQL = registry.ORACLE  # the corpus operators have tests of their own


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    rows_only = set(registry.QUERIES) - set(SQL)
    assert rows_only <= {"patient_context_doc", "readmission_model"}


@pytest.mark.parametrize("key", sorted(SQL))
def test_matches_oracle(spark, duck, key):
    s = E.queries()[key](spark, SF_SMALL).toPandas()
    d = duck.execute(SQL[key]).fetchdf()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    cols = sorted(s.columns)
    assert rows(s, cols) == rows(d, cols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "anomaly_type" in df.columns
