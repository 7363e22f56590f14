"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import compare
from dailybars.catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        view = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(oracle_sql()) & set(QUERIES) and set(QUERIES) <= set(queries())


def test_flagship(spark):
    frame = entry(spark)
    assert frame.columns[-4:] == ["daily_range", "daily_return_pct", "ma_7_day", "ma_30_day"]
    assert frame.count() == 150


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    status, _, _, note = compare(spark, con, name, SF)
    assert status == "ok", note
