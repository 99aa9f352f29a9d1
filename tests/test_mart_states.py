"""Marts from states against the marts themselves, and loads that are taken once."""

import pytest
from conftest import rows

from tillwright.operators import dims
from tillwright.plans import mart_states, marts, model
from tillwright.sources import commits

SALE = """transaction_type string, date_key long, product_key long, customer_key long,
    branch_key long, sales_agent_key long, units long, discount double,
    payment_method string, shipping_state string, total_price double"""
SALES = [
    ("online", 20240131, 1, 1, None, None, 5, 0.5, "card", "Ohio", 10.0),
    ("online", 20240131, 1, 1, None, None, 5, 0.25, "card", "Rome", 20.0),
    ("online", 20240301, 2, 2, None, None, 1, None, "cash", None, None),
    ("online", None, None, None, None, None, 3, 0.0, None, "Rome", 8.0),
    ("offline", 20240215, 1, 1, 1, 1, 9, 0.125, "cash", None, 40.0),
    ("offline", 20240215, 3, 9, 2, 2, 9, 0.0, "cash", None, 5.0),
    ("offline", 20240215, 3, 9, 8, 2, None, 0.0, None, None, 7.0),
    ("offline", 20240215, 3, 9, 8, 2, None, 0.0, None, None, 7.0),
]


@pytest.fixture
def star(spark):
    return {
        "date": dims.date_dim(spark, "2024-01-01", "2024-12-31"),
        "product": spark.createDataFrame(
            [(1, "pen", "office"), (2, "cup", "home"), (3, "pen", "office")],
            "product_key long, product_name string, product_category string"),
        "customer": spark.createDataFrame(
            [(1, 101, "Ann"), (2, 102, "Bob"), (9, 109, "Cy")],
            "customer_key long, customer_id long, customer_name string"),
        "branch": spark.createDataFrame(
            [(1, 1, "Rome"), (2, 2, "Oslo")], "branch_key long, branch_id long, branch_location string"),
        "sales_agent": spark.createDataFrame(
            [(1, "Kim"), (2, "Lou")], "sales_agent_key long, sales_agent_name string"),
    }


@pytest.mark.parametrize("n", [0, 1, len(SALES)])
def test_states_give_the_same_marts(spark, star, n):
    sales = spark.createDataFrame(SALES[:n], SALE)
    want = marts.build(sales, star)
    got = mart_states.build(mart_states.states(sales).cache(), star)
    assert list(got) == list(want)
    for name in want:
        assert got[name].columns == want[name].columns, name
        assert rows(got[name]) == rows(want[name]), name


def test_states_add_up(spark):
    whole = mart_states.states(spark.createDataFrame(SALES, SALE))
    parts = [mart_states.states(spark.createDataFrame(part, SALE)) for part in (SALES[:3], SALES[3:])]
    columns = ["grain", mart_states.CHANNEL, *mart_states.GRAINS, *mart_states.SUMS]
    got = mart_states.added(parts[0].unionByName(parts[1])).select(columns)
    assert rows(got) == rows(whole.select(columns))


def test_one_scan(spark, folder):
    spark.createDataFrame(SALES, SALE).write.parquet(f"{folder}/sales")
    plan = mart_states.states(spark.read.parquet(f"{folder}/sales"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1


def _facts(spark, base, load, part):
    work = commits.Log(spark, base).begin(load)
    for channel in ("online", "offline"):
        sales = spark.createDataFrame(part, SALE).where(f"transaction_type = '{channel}'")
        work.write(model.fact_path(channel), sales.drop("transaction_type"))
    work.commit()


def test_loads_are_taken_once(spark, folder, monkeypatch):
    star, base = f"{folder}/star", f"{folder}/marts"
    assert mart_states.refresh(spark, base, star) is None
    opened, real = [], commits.Log.read_load

    def read_load(log, table, token):
        opened.append(token)
        return real(log, table, token)
    monkeypatch.setattr(commits.Log, "read_load", read_load)
    _facts(spark, star, "a", SALES[:3])
    mart_states.refresh(spark, base, star)
    _facts(spark, star, "b", SALES[:5])
    # A refresh that ends before its commit has taken nothing.
    with monkeypatch.context() as broken:
        broken.setattr(commits.Load, "commit", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            mart_states.refresh(spark, base, star)
    mart_states.refresh(spark, base, star)
    _facts(spark, star, "b", SALES[3:])   # the load is repeated and replaces what it was
    opened.clear()
    got = mart_states.refresh(spark, base, star)
    assert len(set(opened)) == 1
    columns = ["grain", mart_states.CHANNEL, *mart_states.GRAINS, *mart_states.SUMS]
    assert rows(got.select(columns)) == rows(
        mart_states.states(spark.createDataFrame(SALES, SALE)).select(columns))
    opened.clear()
    mart_states.refresh(spark, base, star)
    assert not opened
