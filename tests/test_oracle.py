"""Every registered query against its DuckDB twin, values compared exactly."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from faregate.plans.catalog import QUERIES, TABLES
from faregate.plans.oracle import ORACLE
from tests.conftest import SF
from tools.check_oracle import rows_of

ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_every_query_has_a_twin():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_duckdb(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only_queries_run(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 5
