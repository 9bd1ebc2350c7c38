"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_point
from sitewell.plans import registered
from tests.compare import connect, differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(registered.QUERIES) == set(registered.SQL)
    assert set(registered.QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(registered.QUERIES))
def test_same_as_sql(spark, duck, name):
    assert differences(spark, duck, entry_point.queries()[name], entry_point.oracle_sql()[name], FOLDER) is None
