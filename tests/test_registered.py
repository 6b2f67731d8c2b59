"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as registered
from checks.compare import database, difference
from checks.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return database(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(registered.oracle_sql())


def test_entry(spark):
    assert registered.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, connection, name):
    assert difference(spark, connection, name, SF_DIR) is None
