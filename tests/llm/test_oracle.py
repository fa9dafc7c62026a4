"""The operators that SQL can express against their DuckDB SQL on the sf0.001 tables."""

from __future__ import annotations

import duckdb
import pytest

from tests.conftest import SF0001
from tools.oracle_check import TABLES, digest
from trialguard.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF0001)
    rows = [tuple(r) for r in df.collect()]
    want = con.sql(queries.ORACLE_SQL[name])
    columns, found = want.columns, want.fetchall()
    assert sorted(df.columns) == sorted(columns) and digest(df.columns, rows)[0] == digest(columns, found)[0]
