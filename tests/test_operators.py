import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillwright.operators import channels, dims, facts, incremental, keys, lookup, shaping
from tillwright.plans import merge, standardize
from tillwright.sources import readers, schemas


def test_blank_columns_go_and_a_single_value_keeps_one(spark):
    df = spark.createDataFrame([(None, None, 1), (None, "x", 2)], "a string, b string, c int")
    assert shaping.drop_blank_columns(df).columns == ["b", "c"]
    assert shaping.drop_blank_columns(df, ["b"]).columns == ["a", "b", "c"]


def test_headers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "cusomter_email int, sales_person_id int, class int")
    fixed = shaping.rename_business(shaping.repair_headers(df))
    assert fixed.columns == ["customer_email", "sales_agent_id", "branch_class"]


def test_dates_need_no_leading_zeros_and_bad_ones_are_null(spark):
    df = spark.createDataFrame([("2020-6-3",), ("soon",), (None,)], "transaction_date string")
    got = shaping.cast_dates(df).select(F.col("transaction_date").cast("string")).collect()
    assert [r[0] for r in got] == ["2020-06-03", None, None]


def test_channels(spark):
    df = spark.createDataFrame([(1, "yes"), (2, "no"), (3, None), (4, "Y")],
                               "id int, is_online string")
    tags = [r[0] for r in df.orderBy("id").select(channels.tag()).collect()]
    assert tags == ["online", "offline", "offline", "offline"]
    parts = channels.split(df)
    assert rows(parts["online"]) == [(1,)] and rows(parts["offline"]) == [(2,)]
    assert rows(channels.split_losses(df)) == [(None, 1), ("Y", 1)]


def test_all_sales_has_the_fixed_layout(spark):
    online = spark.createDataFrame([], schemas.ONLINE)
    offline = spark.createDataFrame([], schemas.OFFLINE)
    assert channels.all_sales(online, offline).columns == schemas.ALL_SALES
    assert len(schemas.ALL_SALES) == 24
    assert (len(schemas.RAW), len(schemas.ONLINE), len(schemas.OFFLINE)) == (27, 18, 21)
    assert len(schemas.RAW_WITH_AUDIT) == len(schemas.RAW_AUDIT_INSIDE) == 29


def test_merge_keeps_sales_without_agent_or_branch(spark):
    sold = spark.createDataFrame([("t1", 1, 9), ("t2", None, 1)],
                                 "transaction_id string, sales_agent_id long, branch_id long")
    agents = spark.createDataFrame([(1, "Ann"), (None, "Nobody")], "sales_person_id long, name string")
    branches = spark.createDataFrame([(1, "Rome")], "branch_id long, location string")
    merged = merge.merge_group(sold, agents, branches, "group1")
    got = rows(merged.select("transaction_id", "name", "location", "group"))
    assert got == [("t1", "Ann", None, "group1"), ("t2", None, "Rome", "group1")]


# --- incremental ------------------------------------------------------------------

LOAD = "transaction_id string, transaction_date date, units long"


def _batch(spark, *triples):
    return spark.createDataFrame(triples, "a string, b string, c long").select(
        F.col("a").alias("transaction_id"), F.col("b").cast("date").alias("transaction_date"),
        F.col("c").alias("units"))


def _account(load):
    assert load.rows_in == load.stored + load.known + load.set_aside
    assert load.fresh.count() == load.stored
    return load.rows_in, load.stored, load.known, load.set_aside


@pytest.mark.parametrize("grain", ["day", "month"])
def test_a_load_accounts_for_every_row(spark, folder, grain):
    first = _batch(spark, ("a", "2024-01-01", 1), ("b", "2024-01-02", 2), ("b", "2024-01-02", 1),
                   ("b", "2024-01-02", 1), (None, "2024-01-02", 5), ("n", None, 7))
    path = f"{folder}/t"

    def table(at=path):
        return rows(readers.read_stored(spark, at).select("transaction_id", "units"))

    # Different sales with one id all stay; only the exact copy goes.
    assert _account(incremental.append_new(first, path, "transaction_id", grain=grain)) == (6, 4, 1, 1)
    everything = [("a", 1), ("b", 1), ("b", 2), ("n", 7)]
    assert table() == everything
    # The same batch again adds nothing, to neither table.
    assert _account(incremental.append_new(first, path, "transaction_id", grain=grain)) == (6, 0, 5, 1)
    assert table() == everything
    second = _batch(spark, ("b", "2024-01-02", 9), ("b", "2024-03-02", 1), ("c", "2024-01-03", 3))
    assert _account(incremental.append_new(second, path, "transaction_id", grain=grain)) == (3, 1, 0, 2)
    assert table() == sorted(everything + [("c", 3)])
    aside = readers.read_stored(spark, incremental.set_aside_path(path))
    assert rows(aside.select("transaction_id", "units", incremental.REASON)) == [
        (None, 5, incremental.NO_ID), ("b", 1, incremental.CHANGED), ("b", 9, incremental.CHANGED)]


def test_a_first_load_without_rows(spark, folder):
    path = f"{folder}/t"
    first = _batch(spark, ("a", "2024-01-01", 1))
    assert _account(incremental.append_new(first.limit(0), path, "transaction_id")) == (0, 0, 0, 0)
    assert readers.read_stored(spark, path).count() == 0
    assert _account(incremental.append_new(first, path, "transaction_id")) == (1, 1, 0, 0)
    # A folder that a failed write has left behind is no table yet.
    os.makedirs(f"{folder}/half/_temporary/0")
    assert _account(incremental.append_new(first, f"{folder}/half", "transaction_id")) == (1, 1, 0, 0)


def test_grains_do_not_mix(spark, folder):
    first = _batch(spark, ("a", "2024-01-01", 1))
    incremental.append_new(first, f"{folder}/t", "transaction_id")
    with pytest.raises(ValueError, match="stored by transaction_date"):
        incremental.append_new(first, f"{folder}/t", "transaction_id", grain="month")


def test_new_rows_need_no_sort_of_wide_rows(spark):
    batch = _batch(spark, ("a", "2024-01-01", 1))
    plan = incremental.new_rows(batch, batch.limit(0), "transaction_id")._jdf.queryExecution()
    assert "SortAggregate" not in plan.executedPlan().toString()


def test_merge_distinct_needs_another_target(spark, folder):
    first = _batch(spark, ("a", "2024-01-01", 1))
    first.write.parquet(f"{folder}/t")
    with pytest.raises(ValueError):
        incremental.rewrite_merged(spark, f"{folder}/t", first, f"{folder}/t/")
    more = _batch(spark, ("a", "2024-01-01", 1), ("a", "2024-01-01", 2))
    assert incremental.rewrite_merged(spark, f"{folder}/t", more, f"{folder}/u").count() == 2


def test_a_third_of_the_rows_under_one_id(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 300).alias("v"))
    got = incremental.new_rows(df, df.limit(0), "k")
    assert got.count() == 20_000 + 100


# --- keys ---------------------------------------------------------------------------


def test_numbering_equals_row_number_over_many_partitions(spark):
    df = spark.range(0, 50_000, 1, 16).select((F.col("id") * 7919 % 50_021).alias("id"))
    got = keys.numbered(df, "key", ["id"]).collect()
    expected = {v: i + 1 for i, v in enumerate(sorted(r["id"] for r in got))}
    assert {r["id"]: r["key"] for r in got} == expected
    assert len(got) == 50_000


def test_stored_keys_stay_and_new_ids_follow(spark):
    def dim(*ids):
        return spark.createDataFrame([(i, f"n{i}") for i in ids], "product_id long, product_name string")

    stored = keys.assign_keys(dim(20, 10), "product_key", "product_id")
    assert rows(stored.select("product_id", "product_key")) == [(10, 1), (20, 2)]
    later = keys.assign_keys(dim(5, 10, 20, 30), "product_key", "product_id", stored)
    assert rows(later.select("product_id", "product_key")) == [(10, 1), (20, 2), (30, 4), (5, 3)]


# --- dimensions and facts --------------------------------------------------------------


def test_one_per_id_takes_the_attributes_seen_last(spark):
    df = spark.createDataFrame(
        [(1, "old", "c", 1.0, "2024-01-01"), (1, "new", "c", 2.0, "2024-02-01"),
         (1, "new", "c", 3.0, "2024-02-01"), (None, "x", "c", 1.0, "2024-02-01")],
        "product_id long, product_name string, product_category string, unit_price double, d string"
    ).withColumn("transaction_date", F.col("d").cast("date"))
    assert rows(dims.product(df)) == [(1, "new", "c", 3.0)]


def test_date_dim_bounds(spark):
    days = dims.date_dim(spark, "2020-01-01", "2025-12-31")
    assert days.count() == 2192
    assert days.schema.fieldNames() == schemas.DATE_DIM.fieldNames()
    with pytest.raises(ValueError):
        dims.date_dim(spark, "2020-01-02", "2020-01-01")
    one = spark.createDataFrame([("2024-02-28",), ("2024-03-01",)], "d string")
    assert dims.date_dim_for(one, "d").count() == 3
    assert dims.date_dim_for(one.limit(0), "d").count() == 0


def _sales(spark, n=90):
    """A third of the sales belongs to customer 1; branch 7 is in no dimension."""
    return spark.range(n).select(
        F.concat(F.lit("trx-"), "id").alias("transaction_id"),
        F.expr("date_add(date'2024-01-01', cast(id % 40 as int))").alias("transaction_date"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 10).alias("customer_id"),
        F.lit("n").alias("customer_name"), F.lit("e").alias("customer_email"),
        (F.col("id") % 2).alias("sales_agent_id"),
        F.when(F.col("id") == 5, 7).otherwise(1).cast("long").alias("branch_id"),
        (F.col("id") % 5).alias("product_id"), F.lit(2).cast("long").alias("units"),
        F.lit(1.5).alias("unit_price"), F.lit(0.0).alias("discount"),
        F.lit(3.0).alias("total_price"), F.lit("cash").alias("payment_method"),
        F.lit("s").alias("shipping_street_name"), F.lit("c").alias("shipping_city"),
        F.lit("st").alias("shipping_state"), F.lit("z").alias("shipping_zip_code"),
        F.lit("group1").alias("group"))


def _dims(spark, sales):
    def keyed(natural, key):
        ids = sales.select(natural).distinct().where(F.col(natural) != 7)
        return keys.assign_keys(ids, key, natural)

    return {
        "date": dims.date_dim(spark, "2024-01-01", "2024-01-31"),
        "product": keyed("product_id", "product_key"),
        "customer": keyed("customer_id", "customer_key"),
        "branch": keyed("branch_id", "branch_key"),
        "sales_agent": keyed("sales_agent_id", "sales_agent_key"),
    }


def test_facts_plus_losses_are_all_rows(spark):
    sales = _sales(spark)
    star = _dims(spark, sales)
    lost = facts.losses(sales, star, "offline").first()
    kept = facts.offline(sales, star)
    assert kept.columns == schemas.OFFLINE_FACT
    assert lost.rows_in == 90 and lost.rows_kept == kept.count()
    assert lost.rows_kept + lost.rows_lost == 90
    assert lost.without_branch_key == 1 and lost.without_date == 18
    online = facts.online(sales, star)
    assert online.columns == schemas.ONLINE_FACT and online.count() == 72
    assert facts.online(sales, star, csv=True).columns == schemas.ONLINE_FACT_CSV
    assert facts.offline(sales, star, csv=True).columns == schemas.OFFLINE_FACT_CSV


def test_a_product_with_two_prices_does_not_multiply_facts(spark):
    sales = _sales(spark).withColumn(
        "unit_price", F.when(F.col("units") % 2 == 0, F.rand(1)).otherwise(F.lit(1.0)))
    assert dims.distinct_rows(sales.withColumn("product_name", F.lit("p"))
                              .withColumn("product_category", F.lit("c")), dims.PRODUCT).count() == 90
    one = dims.product(sales.withColumn("product_name", F.lit("p"))
                       .withColumn("product_category", F.lit("c")))
    assert one.count() == 5


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_lookup_equals_a_plain_join(spark, how):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.col("id")).cast("long").alias("k"), F.col("id").alias("v"))
    table = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("label"))
    expected = rows(df.join(table, "k", how).select("k", "v", "label"))
    assert lookup.hot_keys(df, "k", 0.1) == [1]
    got = lookup.salted(df, table, "k", how, [1])
    assert rows(got.select("k", "v", "label")) == expected
    assert rows(lookup.lookup(df, table, "k", how).select("k", "v", "label")) == expected


def test_a_hot_key_is_spread_over_the_partitions(spark):
    df = spark.range(4000).select(F.lit(1).cast("long").alias("k"), F.col("id").alias("v"))
    table = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("label"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = lookup.salted(df, table, "k", "inner", [1])
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    # Four salts over four partitions: not all of them in one place.
    assert len(sizes) > 1 and sum(r["count"] for r in sizes) == 4000
    assert max(r["count"] for r in sizes) < 4000


def test_strict_chain(spark):
    values = {f.name: None for f in schemas.RAW.fields}
    online = values | {"transaction_id": "T 1", "is_online": "yes", "units": 2, "unit_price": 10.0,
                       "offer_1": "True", "customer_fname": "A", "customer_lname": "B",
                       "customer_email": "a@x.org", "shipping_address": "s/c/AZ/z", "group": "group1"}
    other = online | {"is_online": None}
    raw = spark.createDataFrame([tuple(r[f] for f in values) for r in (online, other)], schemas.RAW)
    parts = standardize.standardize_strict(raw)
    assert parts["offline"].count() == 0
    row = parts["online"].first()
    assert (row.transaction_id, row.customer_email, row.total_price, row.shipping_state) == (
        "trx-1", "a@x.com", 19.0, "Arizona")
    assert parts["online"].columns == schemas.ONLINE.fieldNames()
    assert parts["offline"].columns == schemas.OFFLINE.fieldNames()
