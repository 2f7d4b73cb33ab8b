"""Every registered query against its SQL twin."""

import pytest

from rillmart.checks.compare import connect, difference
from rillmart.checks.queries import QUERIES
from rillmart.checks.sql import SQL


@pytest.fixture(scope="module")
def con(request):
    return connect("/root/testdata/sf0.001")


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_twin(spark, sf, con, name):
    assert difference(spark, con, sf, name) is None


def test_entry(spark):
    import __spark_entry__ as e
    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
