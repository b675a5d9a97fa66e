"""Every registered query against its SQL twin on the given tables."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as entry_points
from catalogue.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = entry_points.queries()[name](spark, SF_DIR)
    sql = entry_points.oracle_sql()[name]
    assert differences(result, con, sql) is None


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert len(rows) == 7 and {r["Result"] for r in rows} == {"PASS"}
