import pytest
from pyspark.sql import functions as F

from tillwright.functions import calendar, cleaning, measures


def one(spark, value, expr, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("flags, rate", [
    ({"offer_2": "True", "offer_4": "True"}, 0.10),
    ({}, 0.0),
    ({"offer_5": "True"}, 0.25),
    ({"offer_1": ""}, 0.0),
    ({"offer_1": "promo"}, 0.0),
    ({"offer_1": " yes "}, 0.05),
    ({"offer_1": "False", "offer_3": "true"}, 0.15),
])
def test_discount(spark, flags, rate):
    row = [flags.get(f"offer_{i}") for i in range(1, 6)]
    df = spark.createDataFrame([row], ", ".join(f"offer_{i} string" for i in range(1, 6)))
    assert df.select(cleaning.discount()).first()[0] == rate


def test_discount_takes_other_offers(spark):
    df = spark.createDataFrame([("True",)], "offer_5 string")
    assert df.select(cleaning.discount({"offer_5": 0.20})).first()[0] == 0.20


@pytest.mark.parametrize("address, parts", [
    ("1 Main/Phoenix/AZ/85001", ("1 Main", "Phoenix", "Arizona", "85001")),
    ("a/b", ("a", "b", None, None)),
    (None, (None,) * 4),
])
def test_address(spark, address, parts):
    df = spark.createDataFrame([(address,)], "shipping_address string")
    assert tuple(df.select(*cleaning.address_parts()).first()) == parts


@pytest.mark.parametrize("code, name", [
    ("ZZ", "ZZ"), ("Washington", "Washington"), ("DC", "District of Columbia"), (None, None)])
def test_state(spark, code, name):
    assert one(spark, code, cleaning.state_name) == name


@pytest.mark.parametrize("mode, text, expected", [
    ("lenient", "a b@x.org", "ab@x.com"),
    ("lenient", "a@x.co.uk", "a@x.co.com"),
    ("lenient", "a@x.comjunk!", "a@x.com"),
    ("lenient", "noat.com", "noat.com"),
    ("lenient", "a@x", "a@x"),
    ("lenient", None, None),
    ("strict", "a@x.org", "a@x.com"),
    ("strict", "  a@x.org ", "a@x.com"),
    ("strict", "noat.com", None),
    ("strict", "a@x", None),
    ("strict", None, None),
    ("strict", "!a@x.org", None),
    ("validate", " a@x.org junk", "a@x.org"),
    ("validate", "a@x", None),
])
def test_email(spark, mode, text, expected):
    assert one(spark, text, lambda c: cleaning.email(c, mode)) == expected


def test_email_mode_is_checked():
    with pytest.raises(ValueError):
        cleaning.email("x", "other")


@pytest.mark.parametrize("text, expected", [
    ("trx-12|34", "trx-1234"), (" trx ", None), (None, None), ("7", "trx-7")])
def test_transaction_id(spark, text, expected):
    assert one(spark, text, cleaning.transaction_id) == expected


@pytest.mark.parametrize("price, expected", [(-19.99, 19.99), (19.99, 19.99), (None, None)])
def test_unit_price(spark, price, expected):
    assert one(spark, price, cleaning.unit_price, "double") == expected


def test_total_price(spark):
    df = spark.createDataFrame([(3, 19.99, 0.05)], "u long, p double, d double")
    rounded, exact = df.select(
        cleaning.total_price("u", "p", "d"), cleaning.total_price("u", "p", "d", None)).first()
    assert rounded == 56.972
    assert exact == pytest.approx(56.9715)


@pytest.mark.parametrize("text, expected", [
    ("3.0", 3), ("x", None), (None, None), ("", None), ("9007199254740993", 9007199254740993)])
def test_whole_number(spark, text, expected):
    assert one(spark, text, cleaning.whole_number) == expected


def test_full_name_is_null_with_a_null_part(spark):
    df = spark.createDataFrame([("A", "B"), ("A", None)], "f string, l string")
    assert [r[0] for r in df.select(cleaning.full_name("f", "l")).collect()] == ["A B", None]


@pytest.mark.parametrize("day, key, weekday, week, weekend", [
    ("2024-07-12", 20240712, 6, 28, 1),
    ("2024-07-13", 20240713, 7, 28, 1),
    ("2024-07-14", 20240714, 1, 28, 0),
    ("2021-01-03", 20210103, 1, 53, 0),
])
def test_calendar(spark, day, key, weekday, week, weekend):
    df = spark.createDataFrame([(day,)], "d string").select(F.col("d").cast("date").alias("d"))
    row = df.select(*calendar.parts("d")).first()
    assert (row.date_key, row.day_of_week, row.week_of_year, row.is_weekend) == (
        key, weekday, week, weekend)


def test_growth(spark):
    df = spark.createDataFrame([(150.0, 100.0), (0.0, 150.0), (50.0, 0.0), (1.0, None)],
                               "a double, b double")
    got = [r[0] for r in df.select(measures.growth_percent(F.col("a"), F.col("b"))).collect()]
    assert got == [50.0, -100.0, None, None]


@pytest.mark.parametrize("n, spend, expected", [
    (11, 1001.0, "High Value"), (6, 501.0, "Medium Value"), (10, 5000.0, "Medium Value"),
    (1, 1.0, "Low Value"), (11, 400.0, "Low Value")])
def test_segment(spark, n, spend, expected):
    df = spark.createDataFrame([(n, spend)], "n long, s double")
    assert df.select(measures.segment("n", "s")).first()[0] == expected


def test_formatted(spark):
    df = spark.createDataFrame([(1234567.891,)], "x double")
    assert measures.formatted(df, x=2).first()["x"] == "1,234,567.89"
