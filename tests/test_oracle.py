"""Every registered query against its SQL on the driver's tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql
from lakemart.plans.catalog import QUERIES
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())


def test_entry_runs(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, FOLDER), connection, oracle_sql()[name]) is None
