"""Every registered query against its DuckDB statement on the smallest driver tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as spark_entry
from check_queries import compare
from tierflow.workload.registry import ORACLES, QUERIES

FOLDER = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = compare(spark, con, str(FOLDER), name)
    assert result.startswith("ok") and " type " not in result, result


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns == spark_entry.entry(spark).columns and df.count() > 0
