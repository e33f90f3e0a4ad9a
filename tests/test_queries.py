"""Every registered query that has SQL equals it on the smallest data set."""

import duckdb
import pytest

from check import TABLES, compare
from trolley.catalog import REGISTRY

SF = "/root/testdata/sf0.001"
# Iterative fits take long even on little data; check.py runs them too.
SLOW = {"slim_kkt", "slim_fit_status"}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", [n for n, e in REGISTRY.items() if e.sql is not None and n not in SLOW])
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, name, SF)
    assert ok, note


@pytest.mark.parametrize("name", ["slim_score", "select_by_coef", "fit_factors", "fit_boosted"])
def test_query_without_sql_gives_rows(spark, name):
    assert REGISTRY[name].build(spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
