"""Every query against its SQL counterpart on the same tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from sluice.queries import QUERIES as LIBRARY

from .compare import difference, oracle_connection

QUERIES = queries()
# operators for training text have tests of their own
ORACLE = {name: sql for name, sql in oracle_sql().items() if name in LIBRARY}


@pytest.fixture(scope="module")
def con(data):
    return oracle_connection(data)


def test_every_query_has_sql():
    assert set(LIBRARY) == set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() == 62


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, data, con, name):
    assert difference(QUERIES[name](spark, data), con, ORACLE[name]) is None
