"""Every registered query against its SQL counterpart, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry
from tools.check_queries import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(entry.core_queries()))
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, SF_DIR, entry.core_queries()[name], entry.core_sql().get(name)) == ""


def test_every_query_has_sql():
    assert set(entry.core_queries()) == set(entry.core_sql())


def test_entry(spark):
    row = entry.entry(spark).head()
    assert row["verified"] and row["data_matches"] and row["expected_rows"] == row["actual_rows"] > 0
