import json
import os

from conftest import rows
from pyspark.sql import functions as F

from tillwright.streaming import events as ev
from tillwright.streaming import runner, sinks, views


def message(customer, product, time, amount=10.0, kind="purchase", **more):
    return json.dumps({
        "eventType": kind, "customerId": customer, "productId": product, "timestamp": time,
        "metadata": {}, "quantity": 2, "totalAmount": amount, "paymentMethod": "PayPal", **more})


def put(folder, name, *messages):
    os.makedirs(f"{folder}/in", exist_ok=True)
    with open(f"{folder}/in/{name}", "w") as f:
        f.write("\n".join(messages) + "\n")


def stream(spark, folder):
    return ev.decode(spark.readStream.text(f"{folder}/in"))


def drain(spark, folder, view):
    df = views.VIEWS[view](stream(spark, folder))
    sinks.write_view(df, f"{folder}/{view}", f"{folder}/cp-{view}", sinks.DRAIN).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/{view}")


def test_decode(spark):
    good = message("1", "9", "2024-07-12T10:00:00", metadata={"category": "Books"})
    df = ev.decode(spark.createDataFrame([(good,), ("{bad",)], "value string"))
    got = df.select("customerId", "metadata.category", F.col("date").cast("string"), "quantity")
    assert rows(got) == [(None, None, None, None), ("1", "Books", "2024-07-12", 2)]


def test_late_rows_closed_windows_and_restart(spark, folder):
    put(folder, "1.json",
        message("1", "p", "2024-07-12T10:05:00"), message("2", "p", "2024-07-12T10:50:00", 30.0),
        message("1", "p", "2024-07-12T10:20:00", kind="addToCart"), "{bad json")
    assert drain(spark, folder, "hourly_sales").count() == 0  # nothing is closed yet

    put(folder, "2.json",
        message("3", "p", "2024-07-12T10:30:00", 20.0),    # late, but inside two hours
        message("3", "q", "2024-07-12T12:30:00"))
    drain(spark, folder, "hourly_sales")
    # Only purchases move the watermark: the first event closes nothing, the second does.
    put(folder, "3.json", message("9", "x", "2024-07-12T18:00:00", kind="productView"))
    assert drain(spark, folder, "hourly_sales").count() == 0
    put(folder, "3b.json", message("9", "x", "2024-07-12T18:00:00"))
    got = drain(spark, folder, "hourly_sales")
    expected = [("p", 3, 60.0, 20.0), ("q", 1, 10.0, 10.0)]
    assert rows(got.select("productId", "num_purchases", "total_sales", "avg_sale_value")) == expected

    put(folder, "4.json", message("3", "p", "2024-07-12T10:40:00"))  # beyond the watermark
    put(folder, "5.json", message("9", "y", "2024-07-13T18:00:00"))
    got = drain(spark, folder, "hourly_sales")
    expected += [("x", 1, 10.0, 10.0)]
    assert rows(got.select("productId", "num_purchases", "total_sales", "avg_sale_value")) == expected


def test_segments_on_a_table(spark):
    lines = [message("a", "p", f"2024-07-12T10:{i:02d}:00", 100.0) for i in range(11)]
    lines += [message("b", "p", f"2024-07-12T10:{i:02d}:00", 90.0) for i in range(6)]
    lines += [message("c", "p", "2024-07-12T10:00:00", 9000.0)]
    df = ev.decode(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = views.customer_segmentation(df)
    assert rows(got.select("customerId", "segment")) == [
        ("a", "High Value"), ("b", "Medium Value"), ("c", "Low Value")]
    start = got.select(F.min(F.col("window_start").cast("string"))).first()[0]
    assert start == "2024-06-16 00:00:00"
    assert rows(views.product_inventory(df).select("quantity_sold")) == [(36,)]
    trends = views.payment_method_trends(df).first()
    assert (trends.paymentMethod, trends.num_transactions) == ("PayPal", 18)


def test_latest_event_per_customer_over_batches(spark, folder):
    put(folder, "1.json", message("1", "a", "2024-07-12T10:00:00"),
        message("1", "b", "2024-07-12T11:00:00"), message("2", "c", "2024-07-12T10:00:00"))
    out, cp = f"{folder}/latest", f"{folder}/cp"
    sinks.write_latest(stream(spark, folder), out, cp, sinks.DRAIN).awaitTermination()
    put(folder, "2.json", message("2", "d", "2024-07-12T12:00:00"),
        message("1", "z", "2024-07-12T09:00:00"))
    sinks.write_latest(stream(spark, folder), out, cp, sinks.DRAIN).awaitTermination()
    expected = [("1", "b"), ("2", "d")]
    assert rows(sinks.latest_snapshot(spark, out).select("customerId", "productId")) == expected
    small = sinks.compact(spark, out, f"{folder}/compacted")
    assert rows(small.select("customerId", "productId")) == expected
    cells = sinks.as_cells(sinks.latest_snapshot(spark, out))
    assert cells.columns[:3] == ["row_key", "cf:customerId", "cf:timestamp"]
    assert rows(cells.select("row_key", "`cf:productId`")) == expected


def test_a_replayed_batch_overwrites_itself(spark, folder):
    batch = ev.decode(spark.createDataFrame(
        [(message("1", "a", "2024-07-12T10:00:00"),)], "value string"))
    put_batch = sinks.upsert_latest(f"{folder}/t")
    put_batch(batch, 0)
    put_batch(batch, 0)
    assert spark.read.parquet(f"{folder}/t").count() == 1


def test_fifty_batches_stay_a_small_table(spark, folder):
    put_batch = sinks.upsert_latest(f"{folder}/t", fold_every=4)
    batches = [ev.decode(spark.createDataFrame(
        [(message(str(n % 3), f"p{n}", f"2024-07-12T10:{n:02d}:00"),)], "value string"))
        for n in range(50)]
    for n, batch in enumerate(batches):
        put_batch(batch, n)
        if n in (23, 40):  # a replay after a failure, at a fold and between folds
            put_batch(batch, n)
    kept = [d for d in os.listdir(f"{folder}/t") if "=" in d]
    assert len(kept) <= 2 + 8
    got = sinks.latest_snapshot(spark, f"{folder}/t").select("customerId", "productId")
    assert rows(got) == [("0", "p48"), ("1", "p49"), ("2", "p47")]


def test_archive_and_views_side_by_side(spark, folder):
    put(folder, "1.json", message("1", "p", "2024-07-12T10:05:00"),
        message("1", "p", "2024-07-12T10:06:00", kind="addToCart"),
        message("1", "q", "2024-07-15T10:06:00"))
    queries = runner.start_all(stream(spark, folder), f"{folder}/out", drain=True)
    runner.wait_all(spark, queries)
    assert set(queries) == {"archive", *views.VIEWS}
    archived = spark.read.parquet(f"{folder}/out/archive")
    assert archived.where("eventType = 'purchase'").count() == 2 and archived.count() == 3
    assert spark.read.parquet(f"{folder}/out/hourly_sales").count() == 1
    sinks.archive_flat(stream(spark, folder), f"{folder}/flat", f"{folder}/cp-flat",
                       sinks.DRAIN).awaitTermination()
    assert spark.read.parquet(f"{folder}/flat").count() == 3
