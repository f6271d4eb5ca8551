"""The operators' queries with a SQL check, and the row sets of the others."""

import pytest
from check import compare, connect
from conftest import CHECKED
from larkspur.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, CHECKED), connect(CHECKED), queries.ORACLES[name]) == ""
