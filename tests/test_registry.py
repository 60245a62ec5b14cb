"""Every registered query with SQL gives the rows of that SQL."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import compare

SF_DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, con, name):
    message, _, good = compare(spark, con, SF_DIR, name, entry.queries()[name], SQL[name])
    assert good, message


def test_entry(spark):
    assert entry.entry(spark).columns == ["label", "term", "mean_weight", "rank"]
