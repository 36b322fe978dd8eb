"""Registered queries against their SQL on the smallest sample, and the registry itself."""

import importlib
import sys

import pytest

import __spark_entry__ as contract_entry
from compare import connect, difference
from flowmart.llm.queries import ORACLES, REGISTRY


@pytest.fixture(scope="module")
def con(small):
    connection = connect(small)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, small, name):
    assert difference(REGISTRY[name](spark, small), con, ORACLES[name]) is None


def test_all_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in REGISTRY)
    assert numbers == list(range(1, 14))
    assert {*REGISTRY, "pipeline"} <= set(contract_entry.queries())


def test_entry_without_these_operators(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    entry = importlib.import_module("__spark_entry__")
    assert "pipeline" not in entry.queries() and "fct_border_waits" in entry.queries()
