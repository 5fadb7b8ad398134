"""Every registered query against its SQL."""

import oracle
import pytest

from tributary.plans.catalogue import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    columns, rows = oracle.spark_rows(QUERIES[name](spark, sf_dir))
    sql_columns, sql_rows = oracle.sql_rows(duck, ORACLE[name])
    assert columns == sql_columns
    assert sum(rows.values()) > 0
    assert rows == sql_rows


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
