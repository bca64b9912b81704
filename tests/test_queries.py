"""Every registered query against its SQL statement, over whole tables."""

import os
from pathlib import Path

import compare
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    frame = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert frame.count() > 0
    else:
        assert compare.differences(frame, con, sql) == []
