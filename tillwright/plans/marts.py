"""The fifteen marts, as numbers. ``measures.formatted`` turns them into text.

``sales`` is both facts as one table tagged by ``transaction_type``
(``channels.sales_of``). Sums and counts are taken over it directly; combining
per-channel results is what partial aggregation does anyway. Averages of channel
averages are the exception and keep both steps.

Sales are aggregated by surrogate key before a dimension is joined. The join
then sees one row per key: a product or customer with a third of all sales costs
no more than any other, and the fact table itself is never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillwright.functions.measures import formatted, growth_percent
from tillwright.operators.channels import OFFLINE, ONLINE
from tillwright.sources import sinks

TOP = 10

# Decimals shown of each formatted measure.
DISPLAY = {
    "total_monthly_sales": {"total_sales": 2},
    "total_product_sales": {"total_sales": 2},
    "total_payment_method_sales": {"total_sales": 2},
    "total_customer_sales": {"total_sales": 2},
    "branch_sales": {"total_sales": 2},
    "agent_sales": {"total_sales": 2},
    "top_products": {"total_units": 2},
    "discount_by_product": {"average_discount": 5},
    "total_sales_trend": {"total_sales": 2},
    "total_category_sales": {"total_sales": 2},
    "avg_sales_per_customer": {"average_sales": 2},
    "freq_customers": {},
    "total_sales_by_state": {"total_sales": 2},
    "clv": {"total_sales": 2},
    "monthly_sales": {"growth_rate": 2},
}


def _total(df: DataFrame, *keys: str, measure: str = "total_price", name: str = "total_sales"):
    return df.groupBy(*keys).agg(F.sum(measure).alias(name))


def _regroup(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("total_sales").alias("total_sales"))


def _largest_first(df: DataFrame, measure: str, *then: str) -> DataFrame:
    return df.orderBy(F.desc(measure), *then)


def _offline(sales: DataFrame) -> DataFrame:
    return sales.where(F.col("transaction_type") == OFFLINE)


def _per_month(sales: DataFrame, date_dim: DataFrame) -> DataFrame:
    daily = _total(sales, "date_key")
    days = date_dim.select("date_key", F.year("datee").alias("year"), F.month("datee").alias("month"))
    return _regroup(daily.join(days, "date_key"), "year", "month")


def total_monthly_sales(sales: DataFrame, date_dim: DataFrame) -> DataFrame:
    return _per_month(sales, date_dim).orderBy("year", "month")


def total_product_sales(sales: DataFrame, product_dim: DataFrame) -> DataFrame:
    named = _total(sales, "product_key").join(
        product_dim.select("product_key", "product_name"), "product_key")
    return _largest_first(_regroup(named, "product_name"), "total_sales", "product_name")


def total_payment_method_sales(sales: DataFrame) -> DataFrame:
    return _largest_first(_total(sales, "payment_method"), "total_sales", "payment_method")


def total_customer_sales(sales: DataFrame, customer_dim: DataFrame) -> DataFrame:
    named = _total(sales, "customer_key").join(
        customer_dim.select("customer_key", "customer_id"), "customer_key")
    return _largest_first(_regroup(named, "customer_id"), "total_sales", "customer_id")


def branch_sales(sales: DataFrame, branch_dim: DataFrame) -> DataFrame:
    named = _total(_offline(sales), "branch_key").join(
        branch_dim.select("branch_key", "branch_id"), "branch_key")
    return _largest_first(_regroup(named, "branch_id"), "total_sales", "branch_id")


def agent_sales(sales: DataFrame, sales_agent_dim: DataFrame) -> DataFrame:
    named = _total(_offline(sales), "sales_agent_key").join(
        sales_agent_dim.select("sales_agent_key", "sales_agent_name"), "sales_agent_key")
    return _largest_first(
        _regroup(named, "sales_agent_name"), "total_sales", "sales_agent_name")


def top_products(sales: DataFrame, product_dim: DataFrame, k: int = TOP) -> DataFrame:
    """The ``k`` products with most units; the smaller key wins a tie at the end."""
    units = _total(sales, "product_key", measure="units", name="total_units")
    best = _largest_first(units, "total_units", "product_key").limit(k)
    named = F.broadcast(best).join(
        product_dim.select("product_key", "product_name"), "product_key")
    return _largest_first(
        named, "total_units", "product_key").select("product_name", "total_units")


def discount_by_product(
    sales: DataFrame, product_dim: DataFrame, weighted: bool = False
) -> DataFrame:
    """Mean discount by product: of the channel means, or over all sales if weighted."""
    return _named_mean(sales, product_dim, "product_key", "product_name", "discount",
                       "average_discount", weighted)


def avg_sales_per_customer(
    sales: DataFrame, customer_dim: DataFrame, weighted: bool = False
) -> DataFrame:
    """Mean sale by customer: of the channel means, or over all sales if weighted."""
    return _named_mean(sales, customer_dim, "customer_key", "customer_name", "total_price",
                       "average_sales", weighted)


def _named_mean(sales, dim, key, label, measure, name, weighted):
    if weighted:
        means = sales.groupBy(key).agg(F.avg(measure).alias(name))
    else:
        # One shuffle: both channel sums of a key are columns of one row.
        online = F.col("transaction_type") == ONLINE
        per_key = sales.groupBy(key).agg(
            F.avg(F.when(online, F.col(measure))).alias("online"),
            F.avg(F.when(~online, F.col(measure))).alias("offline"),
        )
        both = (F.col("online") + F.col("offline")) / 2
        means = per_key.select(key, F.coalesce(both, "online", "offline").alias(name))
    named = means.join(dim.select(key, label), key)
    return _largest_first(named, name, key).select(label, name)


def total_sales_trend(sales: DataFrame, date_dim: DataFrame) -> DataFrame:
    daily = _total(sales, "date_key").join(date_dim.select("date_key", "datee"), "date_key")
    return daily.select("datee", "total_sales").orderBy("datee")


def total_category_sales(sales: DataFrame, product_dim: DataFrame) -> DataFrame:
    named = _total(sales, "product_key").join(
        product_dim.select("product_key", "product_category"), "product_key")
    return _largest_first(
        _regroup(named, "product_category"), "total_sales", "product_category")


def freq_customers(sales: DataFrame, customer_dim: DataFrame) -> DataFrame:
    counts = sales.groupBy("customer_key").agg(F.count("*").alias("total_transactions"))
    named = counts.join(customer_dim.select("customer_key", "customer_name"), "customer_key")
    return _largest_first(named, "total_transactions", "customer_key").select(
        "customer_name", "total_transactions")


def total_sales_by_state(sales: DataFrame, branch_dim: DataFrame, k: int = TOP) -> DataFrame:
    """The ``k`` best places: shipping states online, branch locations offline.

    One column holds both kinds; a place that is both gets the sum.
    """
    online = F.col("transaction_type") == ONLINE
    per_place = sales.groupBy(
        online.alias("online"),
        F.when(online, F.col("shipping_state")).alias("state"),
        F.when(~online, F.col("branch_key")).alias("branch_key"),
    ).agg(F.sum("total_price").alias("total_sales"))
    # One pass over the sales for both kinds; an offline place needs its branch.
    branches = branch_dim.select("branch_key", "branch_location", F.lit(True).alias("known"))
    placed = per_place.join(branches, "branch_key", "left").where("online OR known")
    place = F.when(F.col("online"), F.col("state")).otherwise(F.col("branch_location"))
    places = placed.select(place.alias("shipping_state"), "total_sales")
    return _largest_first(
        _regroup(places, "shipping_state"), "total_sales", "shipping_state").limit(k)


def clv(sales: DataFrame, customer_dim: DataFrame) -> DataFrame:
    """Money and units by customer."""
    totals = sales.groupBy("customer_key").agg(
        F.sum("total_price").alias("total_sales"), F.sum("units").alias("total_units"))
    named = totals.join(customer_dim.select("customer_key", "customer_name"), "customer_key")
    return _largest_first(named, "total_sales", "customer_key").select(
        "customer_name", "total_sales", "total_units")


def monthly_sales(sales: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Monthly totals with the previous month's and the growth in percent.

    The window has no partition key, but its input is one row per month of the
    calendar, whatever the number of sales.
    """
    months = Window.orderBy("year", "month")
    with_previous = _per_month(sales, date_dim).withColumn(
        "prev_month_sales", F.lag("total_sales").over(months))
    growth = F.round(growth_percent(F.col("total_sales"), F.col("prev_month_sales")), 2)
    return with_previous.withColumn("growth_rate", growth).orderBy("year", "month")


def build(sales: DataFrame, star: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All marts by name. Each reads its own few columns of the stored facts.

    Not cached: what fifteen column-pruned scans read together is a fraction of
    the rows and columns a cache would have to hold.
    """
    date, product, customer = star["date"], star["product"], star["customer"]
    branch, agent = star["branch"], star["sales_agent"]
    return {
        "total_monthly_sales": total_monthly_sales(sales, date),
        "total_product_sales": total_product_sales(sales, product),
        "total_payment_method_sales": total_payment_method_sales(sales),
        "total_customer_sales": total_customer_sales(sales, customer),
        "branch_sales": branch_sales(sales, branch),
        "agent_sales": agent_sales(sales, agent),
        "top_products": top_products(sales, product),
        "discount_by_product": discount_by_product(sales, product),
        "total_sales_trend": total_sales_trend(sales, date),
        "total_category_sales": total_category_sales(sales, product),
        "avg_sales_per_customer": avg_sales_per_customer(sales, customer),
        "freq_customers": freq_customers(sales, customer),
        "total_sales_by_state": total_sales_by_state(sales, branch),
        "clv": clv(sales, customer),
        "monthly_sales": monthly_sales(sales, date),
    }


def publish(marts: Mapping[str, DataFrame], options: Callable[[str], Mapping[str, str]]) -> None:
    """Write every mart as display text to the database table of its name.

    ``options`` gives the connection for a table, see ``sinks.jdbc_options``.
    """
    for name, mart in marts.items():
        sinks.write_jdbc(formatted(mart, **DISPLAY[name]), options(name))
