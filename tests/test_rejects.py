import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillwright.sources import rejects, schemas

EXPECTED = schemas.ddl("id string, units long, price double, day date, logs string")


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _intake(spark, folder, *files):
    for i, text in enumerate(files):
        _write(f"{folder}/in/{i}.csv", text)
    return rejects.intake(spark, f"{folder}/in", EXPECTED, f"{folder}/out")


HEADER = "units,id,price,day,remark\n"


def test_every_text_is_accounted_for(spark, folder):
    got = _intake(
        spark, folder,
        HEADER + "3,a,1.5,2024-01-02,x\nthree,b,n/a,2024-02-30,y\n,c,,,\n",
        HEADER + '4,d,2.5,2024-01-03,z,surplus\n5,e\n"",f,1e3, 2024-01-04,\n')
    assert (got.rows_in, got.malformed, got.accepted) == (6, 2, 4)
    assert got.rejected == {"id": 0, "units": 2, "price": 1, "day": 1, "logs": 0}
    kept = rejects.accepted(spark, f"{folder}/out")
    assert kept.columns == ["id", "units", "price", "day", "logs", "remark"]
    assert rows(kept.select("id", "units", "price", F.col("day").cast("string"), "remark")) == [
        ("a", 3, 1.5, "2024-01-02", "x"), ("b", None, None, None, "y"),
        ("c", None, None, None, None), ("f", None, 1000.0, "2024-01-04", None)]
    account = rejects.ledger(spark, f"{folder}/out", ["id"])
    assert rows(account.drop(rejects.FILE)) == [
        (None, None, "4,d,2.5,2024-01-03,z,surplus"), (None, None, "5,e"),
        ("b", "day", "2024-02-30"), ("b", "price", "n/a"), ("b", "units", "three"),
        ("f", "units", "")]
    assert {r[0].rsplit("/", 1)[1] for r in account.select(rejects.FILE).collect()} == {"0.csv", "1.csv"}


def test_observed_counts_equal_the_stored_ones(spark, folder):
    lines = "".join(f"{i if i % 7 else 'x'},t{i},{i if i % 5 else '?'},2024-01-01,{',' * (i % 11 == 3)}\n"
                    for i in range(2000))
    got = _intake(spark, folder, HEADER + lines, HEADER + lines)
    stored = {r["rejected_column"]: r["rows"] for r in rejects.counts(spark, f"{folder}/out").collect()}
    bad = [i for i in range(2000) if i % 11 == 3]
    assert stored[None] == got.malformed == 2 * len(bad)
    assert stored["units"] == got.rejected["units"] == 2 * sum(
        1 for i in range(2000) if i % 7 == 0 and i % 11 != 3)
    assert stored["price"] == got.rejected["price"] == 2 * sum(
        1 for i in range(2000) if i % 5 == 0 and i % 11 != 3)
    assert rejects.accepted(spark, f"{folder}/out").count() == got.accepted


def test_empty_files_clashes_and_other_headers(spark, folder):
    got = _intake(spark, f"{folder}/a", HEADER)
    assert (got.rows_in, got.malformed, set(got.rejected.values())) == (0, 0, {0})
    assert rejects.ledger(spark, f"{folder}/a/out").count() == 0
    with pytest.raises(ValueError):
        _intake(spark, f"{folder}/b", "id,Malformed\na,b\n")


def test_each_side_reads_its_own_columns(spark, folder):
    _intake(spark, folder, HEADER + "3,a,1.5,2024-01-02,x\n")
    plan = rejects.accepted(spark, f"{folder}/out").select("units")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<units:bigint,malformed:string>" in plan
    plan = rejects.counts(spark, f"{folder}/out")._jdf.queryExecution().toString()
    scan = plan[plan.rindex("ReadSchema"):]
    assert "units" not in scan and "rejected" in scan
