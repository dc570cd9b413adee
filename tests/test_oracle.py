"""Every query against the same query in SQL, on the smallest sample tables."""

import os

import pytest

import __spark_entry__ as entry
from floodmark.samples import oracle, queries
from compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no sample tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", queries.all_queries())
def test_query_equals_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(queries.all_queries()) == set(oracle.all_oracles())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
