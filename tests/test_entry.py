"""Every registered query against its check SQL, on the smallest tables given."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract
from entries.oracle import oracle
from entries.queries import REGISTRY

PATH = "/root/testdata/sf0.001"
TABLES = ["nation", "customer", "supplier", "part", "orders", "lineitem"]

pytestmark = pytest.mark.skipif(not os.path.isdir(PATH), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{PATH}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert REGISTRY.keys() == oracle().keys()
    assert REGISTRY.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, database, name):
    df = contract.queries()[name](spark, PATH)
    columns = sorted(df.columns)
    wanted = database.execute(contract.oracle_sql()[name])
    names = [c[0] for c in wanted.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in wanted.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == expected


def test_flagship(spark):
    assert contract.entry(spark).count() > 0
