"""Every catalog entry against its SQL: names, types, and all rows."""

import pytest
from compare import connect, spark_rows, spark_types, sql_rows, sql_types

import __spark_entry__ as driver
from tickweave.plans import catalog, oracle

QUERIES = catalog.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, sf_dir, con):
    df = QUERIES[name](spark, sf_dir)
    assert spark_types(df) == sql_types(con, SQL[name])
    names, rows = spark_rows(df)
    wanted_names, wanted = sql_rows(con, SQL[name])
    assert names == wanted_names
    assert not rows - wanted and not wanted - rows


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_entry_offers_every_query():
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())
