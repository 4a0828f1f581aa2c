"""The driver contract on the smallest data: every query against its SQL in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as contract

DATA = contract.SMOKE
NAMES = sorted(contract.QUERIES)  # the training-data operators have tests of their own


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(DATA):
        pytest.skip("no driver tables")
    db = duckdb.connect()
    for file in sorted(os.listdir(DATA)):
        name = file.removesuffix(".parquet")
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{file}'")
    return db


def test_every_query_has_an_oracle():
    assert set(contract.ORACLE) == set(NAMES)
    assert set(NAMES) <= set(contract.queries())


def test_flagship(spark, duck):
    assert contract.entry(spark).columns == ["event_date", "event_type", "events", "amount"]


# Spark type -> the SQL type it is compared as.
TYPES = {
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}


def _plain(value):
    return round(value, 6) if isinstance(value, float) else value  # a large float stays as it is


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    got = contract.queries()[name](spark, DATA)
    want = duck.sql(contract.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert {c: TYPES[t] for c, t in got.dtypes} == {c: str(t) for c, t in zip(want.columns, want.types)}
    at = [want.columns.index(c) for c in columns]
    left = sorted((tuple(_plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    right = sorted((tuple(_plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
    assert left == right
