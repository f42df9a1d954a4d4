"""The queries that have SQL, against it; and what the entry module registers."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import TABLES, compare
from gleanwork.llm.book import BOOK

SMALL = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", [name for name, (_, sql) in BOOK.items() if sql])
def test_sql(spark, name):
    database = duckdb.connect()
    for table in TABLES:
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    assert compare(spark, SMALL, name, database).startswith("ok ")


def test_all_operators_are_registered():
    names = entry_points.queries()
    assert all(sum(name.startswith(f"op{n}_") for name in names) == 1 for n in range(1, 14)) and "pipeline" in names
