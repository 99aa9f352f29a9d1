"""Every registered query of the subpackage against its reference SQL, over whole tables."""

import glob
import os

import duckdb
import pytest

from tillwright.llm import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def duck_views(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def by_name(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    result = duck_views(SF_DIR).execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert by_name(df.collect(), df.columns) == by_name(result.fetchall(), columns)
