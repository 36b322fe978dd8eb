"""Every registered query against its SQL oracle on the smallest sample."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract_entry
from compare import connect, difference

from contract.oracles import ORACLES
from contract.queries import REGISTRY as QUERIES

# Tree models have no SQL form; tests/test_model.py covers them.
TREES = {"prediction_grid", "hurdle_holdout_metrics", "model_summary"}


@pytest.fixture(scope="module")
def con(small):
    connection = connect(small)
    yield connection
    connection.close()


def test_every_query_but_the_trees_has_an_oracle():
    assert set(QUERIES) - set(ORACLES) == TREES


def test_entry(spark):
    assert contract_entry.entry(spark).count() == 4000


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, small, name):
    assert difference(QUERIES[name](spark, small), con, ORACLES[name]) is None
