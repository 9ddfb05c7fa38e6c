"""Every registered query with an oracle equals it on the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# Trained on trees or built from many fits: covered by test_models on small frames.
SLOW = {"fit_stacking", "tune_random", "regularization_path", "grid_search", "random_search", "fit_gbt_early_stop"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_oracles_belong_to_queries():
    assert ORACLES.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLES.keys() - SLOW))
def test_query_without_oracle_has_rows(spark, name):
    assert QUERIES[name](spark, SF).limit(1).count() == 1


def test_entry(spark):
    assert {"group_col", "group_value", "mean", "pct_vs_avg"} <= set(entry.entry(spark).columns)
