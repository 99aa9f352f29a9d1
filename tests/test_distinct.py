from conftest import rows
from pyspark.sql import functions as F

from test_streaming import message, put, stream
from tillwright.streaming import distinct, sinks

KEYS = ["eventType"]


def events(spark, n, customers, days=3):
    """``n`` events over ``days`` days of one month, a third of them of one type and hour."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "purchase").otherwise("view").alias("eventType"),
        (F.xxhash64("id") % customers).cast("string").alias("customerId"),
        F.when(F.col("id") % 3 == 0, F.timestamp_seconds(F.lit(1_720_778_400))).otherwise(
            F.timestamp_seconds(1_720_742_400 + F.col("id") * 7919 % (days * 86_400))).alias("timestamp"))


def exact(df, unit):
    return df.groupBy("eventType", F.date_trunc(unit, "timestamp").alias("period")).agg(
        F.count("*").alias("n"), F.count_distinct("customerId").alias("exact"))


def test_merged_estimates_are_within_their_error(spark):
    df = events(spark, 120_000, 40_000)
    hours = distinct.hourly(df, KEYS)
    days = distinct.merge(hours, "day")
    for merged, unit in ((days, "day"), (distinct.merge(hours, "month"), "month"),
                         (distinct.merge(days.withColumnRenamed("period", "hour"), "month"), "month")):
        both = merged.join(exact(df, unit), [*KEYS, "period"], "full")
        got = both.withColumn("estimate", distinct.estimate()).select(
            "events", "n", distinct.within_error("estimate", "exact").alias("ok")).collect()
        assert got and all(r["events"] == r["n"] and r["ok"] for r in got)


def test_nulls_and_empty_tables(spark):
    df = spark.createDataFrame(
        [("view", None, "2024-07-12 10:00:00"), (None, "a", "2024-07-12 10:10:00"),
         (None, "a", "2024-07-12 11:10:00"), ("view", "b", None)],
        "eventType string, customerId string, t string").withColumn("timestamp", F.to_timestamp("t"))
    day = distinct.merge(distinct.hourly(df, KEYS), "day")
    assert rows(day.select("eventType", "events", distinct.estimate())) == [(None, 2, 1)]
    assert distinct.merge(distinct.hourly(df.limit(0), KEYS), "day").count() == 0


def _drain(spark, folder):
    distinct.write_hours(stream(spark, folder), KEYS, f"{folder}/out", f"{folder}/cp", sinks.DRAIN).awaitTermination()
    return distinct.merge(distinct.stored_hours(spark, f"{folder}/out"), "day").select(
        "eventType", F.col("period").cast("string"), "events", distinct.estimate())


def test_late_events_and_restart(spark, folder):
    put(folder, "1.json", message("1", "p", "2024-07-12T10:05:00"), message("2", "p", "2024-07-13T10:50:00"))
    _drain(spark, folder)
    put(folder, "2.json", message("3", "p", "2024-07-12T10:30:00"),   # a day late
        message("1", "p", "2024-07-12T23:30:00"))
    expected = [("purchase", "2024-07-12 00:00:00", 3, 2), ("purchase", "2024-07-13 00:00:00", 1, 1)]
    assert rows(_drain(spark, folder)) == expected
    folded = distinct.fold(spark, f"{folder}/out", f"{folder}/folded")
    assert folded.count() == 3
    assert rows(distinct.merge(folded, "day").select(
        "eventType", F.col("period").cast("string"), "events", distinct.estimate())) == expected
