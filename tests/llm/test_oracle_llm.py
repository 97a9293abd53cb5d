"""Registered queries with oracle SQL against DuckDB on the test tables."""
import pytest

from oracle import compare, duck
from tidemart.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_oracle(spark, name):
    ok, why = compare(Q.queries()[name](spark, SF), duck(SF), Q.oracle_sql()[name])
    assert ok, why
