import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

# The queries of the optional subpackage have tests of their own.
QUERIES, STATEMENTS = entry.QUERIES, entry.statements()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_a_statement():
    assert set(STATEMENTS) == set(QUERIES)


def test_flagship_query(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_matches_sql(spark, sf, con, name):
    assert difference(QUERIES[name](spark, sf), con, STATEMENTS[name]) is None
