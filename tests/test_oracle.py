"""Every registered query against its SQL equivalent, on the smallest tables."""

import glob
import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry  # noqa: E402
from tools.check import compare  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query(spark, con, name):
    problem, _ = compare(entry.QUERIES[name](spark, FOLDER), con.sql(entry.ORACLES[name]))
    assert not problem


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_an_equivalent():
    assert set(entry.QUERIES) == set(entry.ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())
