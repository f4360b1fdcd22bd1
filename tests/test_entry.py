"""The registry with and without the optional operators."""

import importlib.util
import sys

import pytest

from oracle.sql import ORACLE
from sluice.queries import QUERIES

PRESENT = importlib.util.find_spec("sluice.llm") is not None


def entry():
    import __spark_entry__

    return __spark_entry__


def test_every_query_has_its_sql():
    found, sql = entry().queries(), entry().oracle_sql()
    assert set(QUERIES) <= set(found) and set(ORACLE) <= set(sql) <= set(found)
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.skipif(not PRESENT, reason="the optional operators are not there")
@pytest.mark.parametrize("missing", ["xxhash", "sluice.llm.queries"])
def test_missing_dependency_leaves_the_rest(monkeypatch, missing):
    for name in [n for n in sys.modules if n.startswith("sluice.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    assert set(entry().queries()) == set(QUERIES) and set(entry().oracle_sql()) == set(ORACLE)


@pytest.mark.skipif(not PRESENT, reason="the optional operators are not there")
def test_operators_are_registered():
    found = set(entry().queries()) - set(QUERIES)
    assert "pipeline" in found and len(found) == 1 + len({n.split("_")[0] for n in found if n.startswith("op")}) == 14
