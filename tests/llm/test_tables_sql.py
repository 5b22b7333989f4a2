"""Registered queries against their DuckDB statements, over whole tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from sparksales.llm import queries as registered

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "documents embeddings benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_matches_duckdb(spark, name):
    got = registered.queries()[name](spark, FOLDER)
    with duckdb.connect() as duck:
        for table in TABLES:
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
        found = duck.execute(registered.oracle_sql()[name])
        columns, expected = [column[0] for column in found.description], found.fetchall()
    assert sorted(got.columns) == sorted(columns)
    rows = [tuple(row[column] for column in columns) for row in got.collect()]
    assert len(rows) == len(expected) > 0
    assert sorted(map(repr, rows)) == sorted(map(repr, expected))
