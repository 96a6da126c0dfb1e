"""Every query with an SQL twin against it, over whole tables of the smallest scale."""

import os

import pytest
from compare import connect, difference

from screenloom.plans import oracles, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_twin(spark, con, name):
    assert difference(queries.QUERIES[name](spark, FOLDER), con, oracles.ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(oracles.ORACLES)))
def test_runs(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    assert df.columns and df.count() >= 0
