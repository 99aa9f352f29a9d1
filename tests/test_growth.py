"""Plans and steps that must not grow faster than the input."""

import os
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import rows
from tillwright.functions import cleaning
from tillwright.plans import bridge, denormalise, standardize
from tillwright.sources import schemas, sinks, workspace

SALE = {"transaction_id": "TRX1-2 ", "transaction_date": date(2024, 7, 12), "customer_fname": "Ann",
        "customer_lname": "Lee", "customer_email": "a@b.org", "units": 2, "unit_price": 1.5,
        "offer_1": "True", "is_online": "yes", "shipping_address": "1 Main St/Cairo/AZ/00001"}


def raw(spark):
    values = tuple(SALE.get(n) for n in schemas.RAW.fieldNames())
    return spark.createDataFrame([values], schemas.RAW)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark, folder):
    """Two order lines, one of them without an order, with all the tables they refer to."""
    made = {
        "lineitem": ["1 l_orderkey, 1 l_partkey, 1 l_suppkey, 1 l_linenumber, 2D l_quantity, 0.05D l_discount, "
                     "3D l_extendedprice", "9, 1, 1, 1, 2D, 0.05D, 3D"],
        "orders": ["1 o_orderkey, 1 o_custkey, date'2024-07-12' o_orderdate, 'HIGH' o_orderpriority"],
        "customer": ["1 c_custkey, 'Customer#1' c_name, 1 c_nationkey"],
        "part": ["1 p_partkey, 'pin' p_name, 'STEEL' p_type, 9D p_retailprice"],
        "supplier": ["1 s_suppkey, 'Supplier#1' s_name, 1 s_nationkey"],
        "nation": ["1 n_nationkey, 'EGYPT' n_name, 1 n_regionkey"],
        "region": ["1 r_regionkey, 'AFRICA' r_name"],
    }
    for name, selects in made.items():
        spark.sql(" union all ".join(f"select {s}" for s in selects)).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_lines_are_dealt_by_the_key_of_the_orders_which_bring_their_customers(spark, tables):
    """A round robin sorts whole inputs, and a join by customer shuffles the lines once more."""
    sold = bridge.raw_transactions(spark, tables)
    assert "RoundRobin" not in plan(sold)
    assert [(r["transaction_id"], r["customer_lname"], r["location"]) for r in sold.collect()] == [
        ("TRX1-1 ", "1", "EGYPT")]
    text = sold._jdf.queryExecution().analyzed().toString().splitlines()
    depth = {t: next(len(r) - len(r.lstrip(" :+-")) for r in text if f"{k}#" in r and "Relation" in r)
             for t, k in (("orders", "o_orderkey"), ("customer", "c_custkey"), ("part", "p_partkey"))}
    assert depth["customer"] > depth["part"]


def test_the_rules_stay_out_of_the_method_of_a_stage(spark, folder):
    raw(spark).write.parquet(f"{folder}/raw")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.codegen.hugeMethodLimit")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
        text = plan(standardize.standardize(spark.read.schema(schemas.RAW).parquet(f"{folder}/raw")))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    rules = [line for line in text.splitlines() if "Project" in line and "regexp_replace" in line]
    assert rules and not any("*(" in line.split("Project")[0] for line in rules)


def test_ids_are_cleaned_as_before(spark):
    assert rows(standardize.standardize(raw(spark)).select("transaction_id", "discount")) == [("trx-12", 0.05)]


def test_one_task_of_a_drop_only_copies_rows(spark, folder, monkeypatch):
    written = []
    real = sinks.write_csv
    monkeypatch.setattr(sinks, "write_csv", lambda df, *a, **k: (written.append(plan(df)), real(df, *a, **k)))
    joined = spark.range(4).join(spark.range(2, 9), "id")
    entry._drop_file(joined, folder, "branches_SS_raw_1")
    assert "Join" not in written[0]
    assert os.path.isfile(f"{folder}/branches_SS_raw_1.csv")
    assert rows(spark.read.csv(f"{folder}/branches_SS_raw_1.csv", header=True)) == [("2",), ("3",)]


def test_both_loads_of_a_merge_read_stored_rows(spark, tables):
    merged = entry._QUERIES["merge_dedup"](spark, tables)
    assert "lineitem" not in "".join(merged.inputFiles())
    assert merged.count() == 0


def test_the_loads_of_facts_read_the_joined_sales_once(spark, tables, monkeypatch):
    built = []
    real = bridge.sales
    monkeypatch.setattr(bridge, "sales", lambda *a, **k: (built.append(a), real(*a, **k))[1])
    entry._QUERIES["maintained_marts"](spark, tables)
    assert len(built) == 1


def test_all_sales_are_written_without_a_shuffle(spark, folder, monkeypatch):
    dealt = []
    real = sinks.by_partition
    monkeypatch.setattr(sinks, "by_partition", lambda df, *c: (dealt.append(df.columns), real(df, *c))[1])
    cleaned = standardize.standardize(raw(spark))
    batches = [standardize.channel(cleaned, c) for c in ("online", "offline")]
    denormalise.load(*batches, folder, "month")
    assert len(dealt) == 6
    stored = denormalise.stored(spark, folder)["all"]
    assert [tuple(r) for r in stored.select("transaction_id", F.col("units")).collect()] == [("trx-12", 2)]


def test_names_and_addresses_of_customers_are_computed_before_the_join_with_lines(spark, tables):
    sold = bridge.raw_transactions(spark, tables)
    top = next(line for line in sold._jdf.queryExecution().analyzed().toString().splitlines() if "Project" in line)
    assert "split_part" not in top and "customer_lname" in top
    assert [tuple(r) for r in sold.select("customer_fname", "customer_lname", "customer_email").collect()] == [
        ("Customer", "1", "c1@shop.co.uk")]


def test_an_address_without_an_at_takes_linear_time(spark):
    address = F.concat(F.repeat(F.lit("x"), 200_000), F.lit(". com"))
    began = time.monotonic()
    made = spark.range(1).select(F.when(F.col("id") == 0, address).alias("a")).select(cleaning.email("a").alias("a"))
    assert made.first()["a"] == "x" * 200_000 + ".com"
    assert time.monotonic() - began < 10


@pytest.fixture
def kept(monkeypatch):
    """Columns of the tables that a query stores, by the name they are stored under."""
    columns = {}
    real = workspace.materialize
    monkeypatch.setattr(workspace, "materialize",
                        lambda df, name: (columns.setdefault(name, df.columns), real(df, name))[1])
    return columns


def test_a_count_of_losses_stores_the_columns_of_the_dimensions_only(spark, tables, kept):
    assert [tuple(r)[:3] for r in entry._QUERIES["fact_losses"](spark, tables).collect()] == [(1, 0, 1)]
    assert {"product_id", "customer_email", "branch_establish_date"} < set(kept["sales"])
    assert not {"transaction_id", "shipping_city", "total_price"} & set(kept["sales"])


def test_a_fact_stores_the_columns_of_its_layout(spark, tables, kept):
    found = entry._QUERIES["offline_fact_csv_layout"](spark, tables).collect()
    assert [(r["transaction_id"], r["branch_key"], r["total_price"]) for r in found] == [("trx-11", 1, 13.5)]
    assert {"transaction_id", "total_price"} < set(kept["sales"])
    assert not {"shipping_city", "group"} & set(kept["sales"])


def test_the_id_index_stores_ids_and_dates_of_its_channel(spark, tables, kept):
    assert entry._QUERIES["id_index_known"](spark, tables).count() == 0
    assert kept["online-ids"] == ["transaction_id", "transaction_date"]


def test_the_slim_fact_stores_its_channel_without_names(spark, tables, kept):
    assert entry._QUERIES["online_fact_slim"](spark, tables).count() == 0
    assert {"transaction_id", "shipping_zip_code"} < set(kept["online"])
    assert not {"customer_name", "customer_email", "product_name"} & set(kept["online"])
