"""Registered queries of the subpackage against their SQL twins, value by value."""

import pytest

from riskbook.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, difference


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf_dir, name):
    assert difference(spark, connect(sf_dir), QUERIES[name], ORACLES[name], sf_dir) is None


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
