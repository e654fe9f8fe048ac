"""Every query against its SQL over the smallest tables: names, counts and values."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from skyledger.bindings import all_queries, all_sql
from tests.conftest import SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    return con


def plain(value):
    return repr(value + 0.0) if isinstance(value, float) else repr(value)


def rows(table, names):
    columns = [table.column(name).to_pylist() for name in names]
    return sorted(tuple(map(plain, row)) for row in zip(*columns))


def test_every_query_has_its_sql():
    assert set(all_queries()) == set(all_sql())
    assert set(all_queries()) <= set(entry.queries()) and set(all_sql()) <= set(entry.oracle_sql())


def test_entry(spark):
    result = entry.entry(spark)
    assert result.count() > 0 and result.columns[0] == "Key"


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, database, name):
    result = all_queries()[name](spark, SMALL)
    names = sorted(result.columns)
    got = result.select(*[f"`{n}`" for n in names]).toArrow()
    expected = database.execute(all_sql()[name]).to_arrow_table()
    assert sorted(expected.column_names) == names
    assert got.num_rows == expected.num_rows > 0
    assert rows(got, names) == rows(expected, names)
