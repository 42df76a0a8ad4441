"""Every registered query against its reference SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from demandspark.plans.catalog import QUERIES
from demandspark.plans.oracles import ORACLES
from demandspark.operators import models
from tests.compare import compare, connect

pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="test tables are not present")

# Each of these fits the full boosted model over hundreds of rounds, which takes minutes.
SLOW = {"backtest_gbt", "batch_score", "gbt_forecast", "tree_candidate"}


@pytest.fixture(scope="module")
def connection():
    return connect(SMOKE_DIR)


def test_entry_has_one_row_per_store(spark):
    assert entry(spark).count() == 5


def test_names_agree():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(set(ORACLES) - SLOW))
def test_query_equals_sql(spark, connection, name):
    assert compare(QUERIES[name](spark, SMOKE_DIR), connection, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(SLOW))
def test_tree_query_equals_sql(spark, connection, monkeypatch, name):
    """The registered queries with a few rounds in place of the full number."""
    for fit in ("fit", "fit_matrix"):
        full = getattr(models, fit)
        few = lambda rows, rounds=3, seed=models.DEFAULT_SEED, full=full, **more: full(rows, 3, seed, **more)
        monkeypatch.setattr(models, fit, few)
    assert compare(QUERIES[name](spark, SMOKE_DIR), connection, ORACLES[name]) is None
