"""Every query with a SQL check, on the data of the correctness gate."""

import pytest
from __spark_entry__ import oracle_sql, queries
from check import compare, connect
from conftest import CHECKED


@pytest.fixture(scope="module")
def duck():
    return connect(CHECKED)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, duck, name):
    assert compare(queries()[name](spark, CHECKED), duck, oracle_sql()[name]) == ""
