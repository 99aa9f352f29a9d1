import pytest
from conftest import rows

from tillwright.operators import channels, dims
from tillwright.plans import marts, views

SALE = """transaction_type string, date_key long, product_key long, customer_key long,
    branch_key long, sales_agent_key long, units long, discount double,
    payment_method string, shipping_state string, shipping_city string, total_price double"""


@pytest.fixture
def sales(spark):
    return spark.createDataFrame([
        ("online", 20240131, 1, 1, None, None, 5, 0.1, "card", "Ohio", "Troy", 10.0),
        ("online", 20240131, 1, 1, None, None, 5, 0.2, "card", "Rome", "Troy", 20.0),
        ("online", 20240301, 2, 2, None, None, 1, 0.0, "cash", None, None, 0.0),
        ("offline", 20240215, 1, 1, 1, 1, 9, 0.3, "cash", None, None, 40.0),
        ("offline", 20240215, 3, 9, 2, 2, 9, 0.0, "cash", None, None, 5.0),
        ("offline", 20240215, 3, 9, 8, 2, 1, 0.0, "cash", None, None, 7.0),
    ], SALE)


@pytest.fixture
def products(spark):
    return spark.createDataFrame(
        [(1, 11, "pen", "office"), (2, 12, "cup", "home"), (3, 13, "pen", "office")],
        "product_key long, product_id long, product_name string, product_category string")


@pytest.fixture
def customers(spark):
    return spark.createDataFrame([(1, 101, "Ann"), (2, 102, "Bob"), (9, 109, "Cy")],
                                 "customer_key long, customer_id long, customer_name string")


@pytest.fixture
def branches(spark):
    return spark.createDataFrame([(1, 1, "Rome"), (2, 2, "Oslo")],
                                 "branch_key long, branch_id long, branch_location string")


def test_average_of_channel_averages(sales, customers):
    got = marts.avg_sales_per_customer(sales, customers)
    assert [tuple(r) for r in got.collect()] == [("Ann", 27.5), ("Cy", 6.0), ("Bob", 0.0)]
    weighted = marts.avg_sales_per_customer(sales, customers, weighted=True)
    assert weighted.first()["average_sales"] == pytest.approx(70 / 3)


def test_discount_by_product(sales, products):
    got = marts.discount_by_product(sales, products).collect()
    assert got[0]["average_discount"] == pytest.approx(0.225)


def test_growth_over_months(spark, sales):
    days = dims.date_dim(spark, "2024-01-01", "2024-12-31")
    got = [tuple(r) for r in marts.monthly_sales(sales, days).collect()]
    assert got == [(2024, 1, 30.0, None, None), (2024, 2, 52.0, 30.0, 73.33),
                   (2024, 3, 0.0, 52.0, -100.0)]
    short = dims.date_dim(spark, "2024-02-01", "2024-12-31")
    assert marts.total_monthly_sales(sales, short).count() == 2


def test_places_of_both_kinds_share_a_column(sales, branches):
    got = [tuple(r) for r in marts.total_sales_by_state(sales, branches).collect()]
    # Rome is a state online and a branch offline; branch 8 is unknown.
    assert got == [("Rome", 60.0), ("Ohio", 10.0), ("Oslo", 5.0), (None, 0.0)]
    assert marts.total_sales_by_state(sales, branches, k=1).count() == 1


def test_top_products_breaks_ties_by_key(sales, products):
    got = [tuple(r) for r in marts.top_products(sales, products, k=2).collect()]
    assert got == [("pen", 19), ("pen", 10)]
    assert marts.total_product_sales(sales, products).first()["total_sales"] == 82.0


def test_customer_marts(sales, customers):
    assert rows(marts.freq_customers(sales, customers)) == [("Ann", 3), ("Bob", 1), ("Cy", 2)]
    assert rows(marts.clv(sales, customers)) == [
        ("Ann", 70.0, 19), ("Bob", 0.0, 1), ("Cy", 12.0, 10)]


def test_a_dimension_row_per_key_never_multiplies_sales(sales, products, customers):
    total = sum(r["total_price"] for r in sales.collect())
    for mart in (marts.total_product_sales(sales, products),
                 marts.total_category_sales(sales, products),
                 marts.total_customer_sales(sales, customers)):
        assert sum(r["total_sales"] for r in mart.collect()) == total


def test_registered_views(spark, sales, products, branches):
    parts = channels.split(sales.withColumnRenamed("transaction_type", "is_online").replace(
        {"online": "yes", "offline": "no"}, subset=["is_online"]))
    names = views.register(parts["online"], parts["offline"], products, branches, "v_")
    assert len(names) == 8
    assert spark.table("v_most_selling_products_online").first()["TotalUnitsSold"] == 10
    offers = rows(spark.table("v_most_redeemed_offers_offline"))
    assert offers == [(0.0, 2), (0.3, 1)]
    per_product = rows(spark.table("v_most_redeemed_offers_per_product_offline"))
    assert per_product == [(11, "pen", 0.3, 1)]
    lowest = [tuple(r) for r in spark.table("v_lowest_sales_cities_offline").collect()]
    assert lowest == [("Oslo", 5.0), ("Rome", 40.0)]
    assert spark.table("v_lowest_sales_cities_online").first()["city"] is None


def test_publish_writes_every_mart_as_text(spark, sales, products, customers, branches, monkeypatch):
    agents = spark.createDataFrame([(1, "Al"), (2, "Bo")], "sales_agent_key long, sales_agent_name string")
    star = {"date": dims.date_dim(spark, "2024-01-01", "2024-12-31"), "product": products,
            "customer": customers, "branch": branches, "sales_agent": agents}
    built = marts.build(sales, star)
    assert set(built) == set(marts.DISPLAY) and len(built) == 15
    written = {}
    monkeypatch.setattr(marts.sinks, "write_jdbc",
                        lambda df, options: written.update({options["dbtable"]: df}))
    marts.publish(built, lambda table: {"dbtable": table})
    assert set(written) == set(built)
    assert written["agent_sales"].first()["total_sales"] == "40.00"
    assert written["freq_customers"].first()["total_transactions"] == 3
    assert written["monthly_sales"].collect()[1]["growth_rate"] == "73.33"
