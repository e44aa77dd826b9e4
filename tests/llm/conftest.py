import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import plain  # noqa: E402

SCHEMA = ("doc_id long, text string, source string, found string, statistics int, fp long, row int, n int, id string, "
          "mark int, part int, score string, kept int, key string, dedup_id int, label string")


@pytest.fixture(scope="session")
def tables(spark):
    """The awkward rows with extra columns that operators might use inside, and the empty table."""
    rows = [(*r, "f", 1, 2, 3, 4, "i", 5, 6, "s", 7, "k", 8, "l") for r in plain.awkward()]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, sf):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()]
