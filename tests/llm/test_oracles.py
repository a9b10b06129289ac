"""Queries with a SQL twin agree with DuckDB."""

import os

import duckdb
import pytest

from posegrid.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF_DIR):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{f}'")
    want = con.sql(ORACLE_SQL[name])
    columns = sorted(want.columns)
    got = sorted(map(repr, (tuple(r[c] for c in columns) for r in QUERIES[name](spark, SF_DIR).collect())))
    assert got == sorted(map(repr, want.project(", ".join(columns)).fetchall()))
