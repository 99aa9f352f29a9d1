"""The business views, in SQL over a product dimension and the two facts.

Each aggregates its fact by key in a subquery first and joins the few resulting
rows, for the reasons given in ``marts``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.operators import channels

_BEST_SELLERS = """
SELECT p.product_id AS ProductID, p.product_name AS ProductName,
       sum(f.units) AS TotalUnitsSold, sum(f.revenue) AS TotalRevenue
FROM (SELECT product_key, sum(units) AS units, sum(total_price) AS revenue
      FROM {fact} GROUP BY product_key) f
JOIN {product_dim} p ON p.product_key = f.product_key
GROUP BY p.product_id, p.product_name
ORDER BY TotalUnitsSold DESC, ProductID
"""

_OFFERS = """
SELECT discount AS Offer, count(*) AS most_redeemed_offers
FROM {fact} GROUP BY discount
ORDER BY most_redeemed_offers DESC, Offer
"""

_OFFERS_PER_PRODUCT = """
SELECT p.product_id AS productid, p.product_name AS productname, f.discount AS offers,
       sum(f.redeemed) AS most_redeemed_offers_per_product
FROM (SELECT product_key, discount, count(*) AS redeemed
      FROM {fact} WHERE discount > 0.0 GROUP BY product_key, discount) f
JOIN {product_dim} p ON p.product_key = f.product_key
GROUP BY p.product_id, p.product_name, f.discount
ORDER BY most_redeemed_offers_per_product DESC, productid, offers
"""

_LOWEST_CITIES_ONLINE = """
SELECT shipping_city AS city, sum(total_price) AS total_sales
FROM {fact} GROUP BY shipping_city
ORDER BY total_sales ASC, city LIMIT 10
"""

_LOWEST_CITIES_OFFLINE = """
SELECT b.branch_location AS city, sum(f.total_sales) AS total_sales
FROM (SELECT branch_key, sum(total_price) AS total_sales FROM {fact} GROUP BY branch_key) f
JOIN {branch_dim} b ON b.branch_key = f.branch_key
GROUP BY b.branch_location
ORDER BY total_sales ASC, city LIMIT 10
"""


def most_selling_products(fact: DataFrame, product_dim: DataFrame) -> DataFrame:
    """Units and revenue by product, for either channel's fact."""
    return fact.sparkSession.sql(_BEST_SELLERS, fact=fact, product_dim=product_dim)


def most_redeemed_offers(fact: DataFrame) -> DataFrame:
    """Number of sales by discount, no discount included."""
    return fact.sparkSession.sql(_OFFERS, fact=fact)


def most_redeemed_offers_per_product(fact: DataFrame, product_dim: DataFrame) -> DataFrame:
    """Number of discounted sales by product and discount."""
    return fact.sparkSession.sql(_OFFERS_PER_PRODUCT, fact=fact, product_dim=product_dim)


def lowest_sales_cities_online(fact: DataFrame) -> DataFrame:
    """The ten shipping cities with least sales."""
    return fact.sparkSession.sql(_LOWEST_CITIES_ONLINE, fact=fact)


def lowest_sales_cities_offline(fact: DataFrame, branch_dim: DataFrame) -> DataFrame:
    """The ten branch locations with least sales."""
    return fact.sparkSession.sql(_LOWEST_CITIES_OFFLINE, fact=fact, branch_dim=branch_dim)


def daily_agent_dump(offline: DataFrame) -> DataFrame:
    """Units by agent and product, from denormalised offline sales."""
    totals = offline.groupBy("sales_agent_name", "product_name").agg(
        F.sum("units").alias("total_sold_units"))
    return totals.orderBy("sales_agent_name", "product_name")


def register(
    online_fact: DataFrame, offline_fact: DataFrame, product_dim: DataFrame,
    branch_dim: DataFrame, prefix: str = "",
) -> list[str]:
    """All eight views as temporary views of the session; returns their names."""
    facts = {channels.ONLINE: online_fact, channels.OFFLINE: offline_fact}
    views = {}
    for name, fact in facts.items():
        views[f"most_selling_products_{name}"] = most_selling_products(fact, product_dim)
        views[f"most_redeemed_offers_{name}"] = most_redeemed_offers(fact)
        views[f"most_redeemed_offers_per_product_{name}"] = most_redeemed_offers_per_product(
            fact, product_dim)
    views["lowest_sales_cities_online"] = lowest_sales_cities_online(online_fact)
    views["lowest_sales_cities_offline"] = lowest_sales_cities_offline(offline_fact, branch_dim)
    for name, view in views.items():
        view.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in views]
