"""Every registered query equals its SQL twin (DuckDB) on the smallest driver tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from topicflow.plans import catalog  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_sql(spark, con, name):
    line, ok = compare(spark, name, catalog.queries()[name], catalog.oracle_sql().get(name), SF, con)
    assert ok, line


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["group", "topic", "partition", "current_offset", "log_end_offset", "lag"]
