"""Every registered query against its DuckDB statement."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    yield connection
    connection.close()


def canonical(frame: pd.DataFrame) -> list[tuple]:
    def plain(value):
        if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
            return ""
        if isinstance(value, float):
            return repr(float(value))
        if isinstance(value, pd.Timestamp):
            return str(value.date())
        return str(value)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(plain(value) for value in row) for row in frame.astype(object).itertuples(index=False))


# Queries of the optional training-data package are tested beside it.
OPTIONAL = set(contract.training_data.queries()) | {"pipeline"} if contract.training_data else set()


def test_same_names():
    assert set(contract.queries()) - OPTIONAL == set(contract.oracle_sql()) - OPTIONAL


@pytest.mark.parametrize("name", [name for name in contract.queries() if name not in OPTIONAL])
def test_matches_duckdb(spark, duck, name):
    got = contract.queries()[name](spark, FOLDER)
    expected = duck.sql(contract.oracle_sql()[name])
    assert sorted(got.columns) == sorted(expected.columns)
    left, right = canonical(got.toPandas()), canonical(expected.df())
    assert len(left) == len(right) and len(left) > 0
    assert left == right
