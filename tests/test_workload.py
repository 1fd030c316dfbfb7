"""Every registered query against its SQL in DuckDB, on the smallest driver tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as driver  # noqa: E402
from snaptide.workload import QUERIES  # noqa: E402
from check_oracle import compare, duck  # noqa: E402

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    same, note = compare(spark, connection, name, SF_DIR)
    assert same, note


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
