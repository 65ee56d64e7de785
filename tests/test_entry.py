"""The registered queries against DuckDB on the smallest tables."""

import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def _plain(value):
    """One form for numbers of any kind; null stays apart from NaN."""
    if isinstance(value, float | Decimal):
        number = float(value)
        return int(number) if number.is_integer() else number
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(str([_plain(row[i]) for i in order]) for row in rows)


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    want = duck.execute(entry.oracle_sql()[name])
    names = [x[0] for x in want.description]
    assert sorted(got.columns) == sorted(names)
    assert _rows(got.columns, got.collect()) == _rows(names, want.fetchall())


def test_flagship(spark):
    table = entry.entry(spark)
    assert table.columns == ["cluster_id", "label", "description", "size", "share", "examples"]
    assert table.count() >= 2
