"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF0001
from tools.oracle_check import TABLES, digest
from trialguard.plans import catalog

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF0001)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(rows) > 0
        return
    res = con.sql(SQL[name])
    ocols, orows = res.columns, res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(cols, rows)[0] == digest(ocols, orows)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 6 and "Category" in df.columns
