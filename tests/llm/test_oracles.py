"""Queries against SQL over the whole tables, where SQL can say them."""

import pytest

from loanmeter.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import differences, oracle

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(set(ORACLE_SQL) - {"op4_source_mixing", "op11_line_dedup"}))
def test_against_sql(spark, name):
    found, expected, surplus, missing, rows = differences(QUERIES[name](spark, SF), oracle(SF), ORACLE_SQL[name])
    assert found == expected and not surplus and not missing and rows == 1000
