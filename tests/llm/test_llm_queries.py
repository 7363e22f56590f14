"""Queries of this subpackage that SQL can express, against their SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from check_queries import compare
from dailybars.llm.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.splitext(os.path.basename(path))[0]} AS SELECT * FROM '{path}'")
    return connection


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, con, name):
    status, _, _, note = compare(spark, con, name, SF)
    assert status == "ok", note
