"""Every catalog query against its SQL form, and the entry points."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from assaylake.catalog.all import QUERIES
from tests.oracle import connect, difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


# The optional parts are tested on their own.
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert difference(duck, queries()[name](spark, FOLDER), oracle_sql()[name]) is None


def test_entry(spark):
    assert {r["status_desc"] for r in entry(spark).collect()} <= {"Open", "Filled", "Unknown"}
