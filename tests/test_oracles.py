"""Every registered query against its reference SQL, over whole tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The training-data operators have tests of their own.
QUERIES, ORACLES = entry._QUERIES, entry.oracles.build()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def _by_name(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = df.collect()
    if name not in ORACLES:
        assert got
        return
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert _by_name(got, df.columns) == _by_name(result.fetchall(), columns)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(ORACLES) == set(QUERIES)


def test_entry_runs(spark):
    assert entry.entry(spark).columns == [
        "ProductID", "ProductName", "TotalUnitsSold", "TotalRevenue"]
