import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillwright.plans import denormalise, merge, model, standardize
from tillwright.sources import kafka, manifest, readers, schemas, sinks, tables, workspace


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_reconcile_by_name(spark, folder):
    _write(f"{folder}/a.csv", "units,remark,transaction_id\n3,hi,t1\nx,yo,t2\n")
    expected = schemas.ddl("transaction_id string, units long, price double")
    got = readers.reconcile(readers.read_csv(spark, f"{folder}/a.csv"), expected, partitions=2)
    assert got.columns == ["transaction_id", "units", "price", "remark"]
    assert [f.dataType.typeName() for f in got.schema] == ["string", "long", "double", "string"]
    assert rows(got) == [("t1", 3, None, "hi"), ("t2", None, None, "yo")]


def test_newest_csv(spark, folder):
    for i, name in enumerate(("old", "new")):
        _write(f"{folder}/d/{name}.csv", f"units\n{i}\n")
        os.utime(f"{folder}/d/{name}.csv", (1_700_000_000 + i, 1_700_000_000 + i))
    got = readers.read_latest_csv(spark, f"{folder}/d", schemas.ddl("units long"))
    assert rows(got) == [(1,)]
    os.makedirs(f"{folder}/empty")
    assert readers.read_latest_csv(spark, f"{folder}/empty", schemas.ddl("units long")) is None


def test_read_any(spark, folder):
    _write(f"{folder}/a.csv", "x\n1\n")
    _write(f"{folder}/b.json", '{"x": 1}\n{"x": 2}\n')
    _write(f"{folder}/c.json", '[{"x": 1},\n {"x": 2}]')
    assert rows(readers.read_any(spark, f"{folder}/a.csv")) == [("1",)]
    assert readers.read_any(spark, f"{folder}/b.json").count() == 2
    assert readers.read_any(spark, f"{folder}/c.json", multiline=True).count() == 2
    assert readers.read_any(
        spark, f"{folder}/b.json", strategy=lambda df: df.where("x > 1")).count() == 1
    with pytest.raises(ValueError):
        readers.read_any(spark, f"{folder}/a.xml")


def test_drops_with_columns_in_the_middle(spark, folder):
    names = schemas.RAW_AUDIT_INSIDE.fieldNames()
    values = ["" if n != "logs" else "seen" for n in names]
    _write(f"{folder}/g6.csv", ",".join(names) + "\n" + ",".join(values) + "\n")
    enforced = readers.read_csv(spark, f"{folder}/g6.csv", schemas.RAW_AUDIT_INSIDE)
    assert enforced.first()["logs"] == "seen"
    by_name = readers.reconcile(readers.read_csv(spark, f"{folder}/g6.csv"), schemas.RAW)
    assert by_name.columns[-2:] == ["logs", "source"] and by_name.first()["logs"] == "seen"


def test_single_file_only_when_asked_for(spark, folder):
    df = spark.range(100).repartition(4)
    sinks.write_report(df, f"{folder}/one", "id", single=True)
    aqe = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(aqe, "false")
    try:
        sinks.write_report(df, f"{folder}/many", "id")
    finally:
        spark.conf.set(aqe, "true")
    files = {p: sorted(f for f in os.listdir(f"{folder}/{p}") if f.endswith(".csv"))
             for p in ("one", "many")}
    assert len(files["one"]) == 1 and len(files["many"]) == 4
    with open(f"{folder}/one/{files['one'][0]}") as f:
        assert f.read().split() == ["id", *map(str, range(100))]
    assert readers.read_csv(spark, f"{folder}/many").count() == 100


def test_hot_day_is_split_into_several_files(spark, folder):
    """Two thirds of the rows on one day do not all pass through one task."""
    df = spark.range(200_000).select(
        F.expr("sha2(cast(id AS string), 256)").alias("text"),
        F.when(F.col("id") % 3 > 0, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02"))
        .cast("date").alias("transaction_date"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "1MB")
    try:
        sinks.write_partitioned(df.repartition(8), f"{folder}/t")
    finally:
        spark.conf.set(size, before)
    files = [f for f in os.listdir(f"{folder}/t/transaction_date=2024-01-01") if f.endswith("parquet")]
    assert len(files) > 3
    assert spark.read.parquet(f"{folder}/t").count() == 200_000


def test_grain_is_checked(spark, folder):
    with pytest.raises(ValueError):
        sinks.write_partitioned(spark.range(1), folder, "id", grain="week")


# --- complete drops -----------------------------------------------------------------


def _files(spark, *entries):
    return spark.createDataFrame(entries, "path string, t string").select(
        "path", F.col("t").cast("timestamp").alias("modified"))


def test_newest_complete_drop(spark):
    fresh, stale = "2024-07-12 10:30:00", "2024-07-12 08:00:00"
    kinds = manifest.KINDS
    files = _files(
        spark,
        *[(f"/in/group1/{k}_SS_raw_1.csv", fresh) for k in kinds if k != "sales_agents"],
        *[(f"/in/group2/{k}_SS_raw_1.csv", stale) for k in kinds],
        *[(f"/in/group2/{k}_SS_raw_2.csv", fresh) for k in kinds],
        *[(f"/in/group3/{k}_SS_raw_3.csv", stale) for k in kinds],
        *[(f"/in/group4/{k}_SS_raw_4.csv", fresh) for k in kinds],
        ("/in/group2/readme.txt", fresh))
    as_of = F.lit("2024-07-12 11:00:00").cast("timestamp")
    got = manifest.latest_complete_group(files, as_of)
    assert rows(got.select("group_number", "path")) == sorted(
        (2, f"/in/group2/{k}_SS_raw_2.csv") for k in kinds)
    late = F.lit("2024-07-13 11:00:00").cast("timestamp")
    assert manifest.latest_complete_group(files, late).count() == 0


def test_merge_of_a_drop_from_files(spark, folder):
    base = f"{folder}/group4"
    _write(f"{base}/branches_SS_raw_4.csv",
           "branch_id,location,establish_date,class\n1,New York,2017-01-15,A\n")
    _write(f"{base}/sales_agents_SS_raw_4.csv",
           "sales_person_id,name,hire_date\n1,John Doe,2020-9-10\n")
    _write(f"{base}/sales_transactions_SS_raw_4.csv",
           "transaction_id,sales_agent_id,branch_id,cusomter_email,units\n"
           "trx-1,1,1,a@x.org,2\ntrx-2,,,b@x.org,1\n")
    files = manifest.listing(spark, folder, "*.csv")
    drop = manifest.latest_complete_group(files, F.current_timestamp())
    merged = merge.merge_drop(spark, drop)
    assert rows(merged.select("transaction_id", "name", "location", "customer_email", "group")) == [
        ("trx-1", "John Doe", "New York", "a@x.org", "group4"),
        ("trx-2", None, None, "b@x.org", "group4")]


def test_path_rules(spark):
    df = spark.createDataFrame([("/drops/group12/x.csv",), ("/none",)], "path string")
    got = df.select(manifest.group_number("path"), manifest.path_part("path", 3)).collect()
    assert [tuple(r) for r in got] == [(12, "group12"), (None, None)]


# --- layers -------------------------------------------------------------------------------


def _raw(spark, *ids, price=10.0):
    values = {f.name: None for f in schemas.RAW.fields}
    out = []
    for i in ids:
        online = i % 2 == 0
        out.append(values | {
            "transaction_id": f"T{i}", "customer_id": i % 3, "product_id": i % 4, "units": 2,
            "unit_price": price, "customer_fname": "A", "customer_lname": str(i % 3),
            "customer_email": "a@x.org", "product_name": f"p{i % 4}", "product_category": "c",
            "is_online": "yes" if online else "no", "payment_method": "cash", "group": "group1",
            "shipping_address": "s/c/AZ/z" if online else None,
            "sales_agent_id": None if online else 1, "branch_id": None if online else 1,
            "name": None if online else "Ann", "location": None if online else "Rome"})
    df = spark.createDataFrame([tuple(r[f] for f in values) for r in out], schemas.RAW)
    return df.withColumn("transaction_date",
                         F.expr("date_add(date'2024-07-01', cast(units AS int))"))


def _load(spark, std, den, norm):
    denormalise.run(spark, std, den)
    return model.refresh(spark, norm, den)


def test_layers_end_to_end_and_loading_again(spark, folder):
    std, den, norm = (f"{folder}/{n}" for n in ("std", "den", "norm"))
    standardize.run(_raw(spark, *range(6)), std, "20240712100000")
    star = _load(spark, std, den, norm)
    assert star["online_fact"].count() == 3 and star["offline_fact"].count() == 3
    keys_before = rows(star["product"].select("product_id", "product_key"))

    # A later run overlaps, changes a price and brings new products.
    standardize.run(_raw(spark, *range(4, 9), price=-20.0), std, "20240712110000")
    newest = denormalise.newest_run(spark, std)
    assert newest["online"].count() == 3 and newest["online"].first()["unit_price"] == 20.0
    star = _load(spark, std, den, norm)
    assert star["online_fact"].count() + star["offline_fact"].count() == 9
    keys_after = rows(star["product"].select("product_id", "product_key"))
    assert set(keys_before) <= set(keys_after)
    assert len({k for _, k in keys_after}) == len(keys_after) == 4
    assert model.sales(star).count() == 9

    # The same run once more changes nothing.
    star = _load(spark, std, den, norm)
    assert model.sales(star).count() == 9
    assert rows(star["product"].select("product_id", "product_key")) == keys_after


def test_standardized_run_is_stored_by_date_with_its_schema(spark, folder):
    paths = standardize.run(_raw(spark, 1, 2), folder, "20240712135616")
    assert paths["online"].endswith(
        "standardized_sales_transaction_2024-07-12/online_transactions_group1_20240712135616")
    assert any(d.startswith("transaction_date=") for d in os.listdir(paths["online"]))
    back = readers.read_with_sidecar(spark, paths["offline"])
    assert sorted(back.columns) == sorted(schemas.OFFLINE.fieldNames())


# --- tables, options --------------------------------------------------------------------


def test_external_tables_leave_files_alone(spark, folder):
    df = spark.createDataFrame([(1, "a")], "id long, name string")
    sinks.write_csv(df, f"{folder}/t")
    tables.create_external(spark, "ext_test", {"t": (df.schema, f"{folder}/t")},
                           location=f"{folder}/db")
    assert rows(spark.sql("SELECT id, name FROM ext_test.t")) == [(1, "a")]
    spark.sql("DROP TABLE ext_test.t")
    assert readers.read_csv(spark, f"{folder}/t").count() == 1


def test_jdbc_goes_through_options(monkeypatch):
    seen = {}

    class Writer:
        def format(self, kind):
            seen["format"] = kind
            return self

        def options(self, **kw):
            seen.update(kw)
            return self

        def mode(self, mode):
            seen["mode"] = mode
            return self

        def save(self):
            seen["saved"] = True

    class Frame:
        write = Writer()

    options = sinks.jdbc_options("jdbc:x", "marts.clv", "u", "p", fetchsize="1")
    sinks.write_jdbc(Frame(), options)
    assert seen["format"] == "jdbc" and seen["mode"] == "overwrite" and seen["saved"]
    assert seen["dbtable"] == "marts.clv" and seen["truncate"] == "true" and seen["fetchsize"] == "1"


def test_kafka_options():
    plain = kafka.options("h:1", "topic")
    assert plain == {"kafka.bootstrap.servers": "h:1", "subscribe": "topic",
                     "startingOffsets": "earliest"}
    secure = kafka.options("h:1", "topic", "me", "secret", max_per_trigger=10)
    assert secure["kafka.security.protocol"] == "SASL_SSL"
    assert 'username="me" password="secret"' in secure["kafka.sasl.jaas.config"]
    assert secure["maxOffsetsPerTrigger"] == "10"


def test_workspace_follows_the_session(spark):
    assert workspace.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert workspace.fresh_path(spark, "a") != workspace.fresh_path(spark, "a")


def test_a_small_load_reads_no_history(spark, folder, monkeypatch):
    """After a full load, dimensions and facts of a small one see its own rows only."""
    std, den, norm = (f"{folder}/{n}" for n in ("std", "den", "norm"))
    standardize.run(_raw(spark, *range(40)), std, "20240712100000")
    _load(spark, std, den, norm)
    standardize.run(_raw(spark, *range(36, 45)), std, "20240712110000")
    seen = []
    real = model.dimension_rows
    monkeypatch.setattr(model, "dimension_rows", lambda all_sales, offline: seen.append(
        (all_sales.count(), offline.count())) or real(all_sales, offline))
    star = _load(spark, std, den, norm)
    assert seen == [(5, 2)]
    assert model.sales(star).count() == 45
    assert star["offline_losses"].first()["rows_in"] == 2
    assert denormalise.stored(spark, den)["all"].count() == 45


def test_csv_text_is_not_altered(spark, folder):
    df = spark.createDataFrame([(" a ", "x"), ("", "y"), (None, "z"), ('q"u,o', " ")], "t string, u string")
    sinks.write_csv(df, f"{folder}/t")
    assert rows(readers.read_csv(spark, f"{folder}/t", df.schema)) == rows(df)


def test_a_header_in_another_order_is_an_error(spark, folder):
    df = spark.createDataFrame([(1, 2)], "a long, b long")
    sinks.write_csv(df.select("b", "a"), f"{folder}/t")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_csv(spark, f"{folder}/t", df.schema).collect()


def test_a_drop_lands_in_the_raw_layer(spark, folder):
    base = f"{folder}/drops/group4"
    _write(f"{base}/branches_SS_raw_4.csv",
           "branch_id,location,establish_date,class\n1,New York,2017-01-15,A\n")
    _write(f"{base}/sales_agents_SS_raw_4.csv",
           "sales_person_id,name,hire_date\n7,John Doe,2020-9-10\n")
    _write(f"{base}/sales_transactions_SS_raw_4.csv",
           "transaction_id,sales_agent_id,branch_id,cusomter_email,units,transaction_date,is_online\n"
           "trx-1,7,1,a@x.org,2,2024-07-01,no\n")
    now = F.current_timestamp()
    path = merge.land(spark, f"{folder}/drops", f"{folder}/raw", "20240712135616", now)
    assert path.endswith("raw_sales_transactions_2024-07-12")
    raw = readers.read_csv(spark, path, schemas.RAW)
    assert rows(raw.select("transaction_id", "sales_agent_id", "name", "group")) == [
        ("trx-1", 7, "John Doe", "group4")]
    later = now + F.expr("interval 3 hours")
    assert merge.land(spark, f"{folder}/drops", f"{folder}/raw", "20240712135616", later) is None
