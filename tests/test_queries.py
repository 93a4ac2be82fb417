"""Every registered query against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, normal

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, name):
    df = queries()[name](spark, SF)
    got = normal(df.columns, df.collect())
    if name in oracle_sql():
        cursor = db.execute(oracle_sql()[name])
        assert got == normal([d[0] for d in cursor.description], cursor.fetchall())
    else:
        assert got[1]


def test_entry(spark):
    assert entry(spark).count() == 10
