"""Every registered query against its SQL twin, value by value; model queries must give rows.

Grid searches of hundreds of fits run with RISKBOOK_LONG=1 only; tests/test_models.py compares each kind of search with
the library's own on small grids.
"""

import os

import pytest

from riskbook.catalog import ORACLES, QUERIES
from tests.oracle import connect, difference


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_same_rows_as_sql(spark, connection, sf_dir, name):
    assert difference(spark, connection, QUERIES[name], ORACLES[name], sf_dir) is None


LONG = {"cv_table", "cv_table_forest", "cv_table_boosted", "cv_table_svm"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_model_query_gives_rows(spark, sf_dir, name):
    if name in LONG and not os.environ.get("RISKBOOK_LONG"):
        pytest.skip("long: set RISKBOOK_LONG=1")
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_twin_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
