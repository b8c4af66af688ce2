"""Every registered query against its SQL on DuckDB, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "tools"))

import __spark_entry__ as entry
from compare import difference, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
WITHOUT_SQL = {"tree_scores", "forest_scores", "tuned_tree"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(entry.ORACLES))
def test_query_equals_sql(spark, con, name):
    assert difference(entry.REGISTRY[name](spark, SF), con, entry.ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(entry.REGISTRY) - set(entry.ORACLES) == WITHOUT_SQL
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
