"""Every query of the book against its SQL, on the smallest test tables."""

from __future__ import annotations

import pathlib

import pytest

import __spark_entry__ as entry_points
import querybook
from check import TABLES, compare

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SMALL).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def database():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", querybook.BOOK)
def test_query(spark, database, name):
    assert compare(spark, SMALL, name, database).startswith("ok ")


def test_entry(spark):
    assert not entry_points.entry(spark).isEmpty()


def test_every_sql_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
