"""Every registered query against its SQL in an independent engine."""

import glob
import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry_module  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"create view {name} as select * from '{path}'")
    return connection


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    return f"{value:.6f}" if isinstance(value, float) else str(value)


def as_lists(frame):
    columns = sorted(frame.columns)
    return columns, sorted([cell(v) for v in row] for row in frame[columns].itertuples(index=False))


def test_every_query_has_sql():
    assert set(entry_module.QUERIES) == set(entry_module.ORACLE)


@pytest.mark.parametrize("name", sorted(entry_module.QUERIES))
def test_query(spark, engine, name):
    ours = as_lists(entry_module.queries()[name](spark, SF_DIR).toPandas())
    theirs = as_lists(engine.sql(entry_module.oracle_sql()[name]).df())
    assert ours == theirs


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
