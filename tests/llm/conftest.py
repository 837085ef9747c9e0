import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odd_rows import SCHEMA, rows  # noqa: E402


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).checkpoint()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def some_docs(spark):
    """A given table with its texts by id."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return docs, {r["doc_id"]: r["text"] for r in docs.collect()}
