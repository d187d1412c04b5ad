"""Every registered query against its SQL counterpart on the test tables."""

import os

import pytest

import __spark_entry__ as entry
from check import oracle_rows, spark_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, name):
    columns, found = spark_rows(entry.queries()[name](spark, SF_DIR))
    expected_columns, expected = oracle_rows(SF_DIR, entry.oracle_sql()[name])
    assert columns == expected_columns
    assert found == expected


def test_entry_is_the_flagship_query(spark):
    assert entry.entry(spark).columns[:3] == ["window_start", "window_end", "name"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
