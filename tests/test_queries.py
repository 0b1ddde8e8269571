"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pytest
from oracle import compare

from millrace.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_oracle(spark, name):
    assert compare(spark, name, QUERIES[name], ORACLES[name], SF) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0


def test_entry_module_without_the_subpackage(monkeypatch):
    import importlib
    import sys

    monkeypatch.setitem(sys.modules, "millrace.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(ORACLES)
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
