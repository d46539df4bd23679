"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare
from tidemark.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    # text queries that SQL cannot express have tests of their own
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_sql(spark, name):
    assert compare(spark, SF_DIR, name) == ""


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == ["region", "userid_ts", "payload"]
    assert frame.count() == 600
