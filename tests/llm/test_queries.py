"""Registered queries against their SQL."""

import oracle
import pytest

from tributary.llm import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, sf_dir, name):
    columns, rows = oracle.spark_rows(QUERIES[name](spark, sf_dir))
    sql_columns, sql_rows = oracle.sql_rows(duck, ORACLE[name])
    assert columns == sql_columns
    assert sum(rows.values()) > 0
    assert rows == sql_rows
