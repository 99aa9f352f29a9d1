"""All marts from one scan of the sales, and marts kept up by adding loads.

:func:`states` is one aggregate with a grouping set per grain. Spark expands a sale into
one row per grain inside the scan and adds up in every task, so the facts are read once
and a key with a third of all sales sends one row per task and channel. States hold sums
and counts by channel, which add up: the states of two loads together are those of
both, whatever was loaded before. So a load is taken by reading its own facts only.
Means, channel means and the best ``k`` are computed from the added states when read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.operators import channels
from tillwright.operators.channels import OFFLINE, ONLINE
from tillwright.plans import marts, model
from tillwright.sources import commits

CHANNEL = "transaction_type"
GRAINS = ("date_key", "product_key", "customer_key", "branch_key", "sales_agent_key",
          "payment_method", "shipping_state")
SUMS = ("total_price", "units", "discounts", "transactions", "priced", "discounted")
TABLE = "mart_states"


def states(sales: DataFrame) -> DataFrame:
    """Sums and counts per channel and key, for every grain; ``grain`` names the key column.

    A null key is a key like others. ``sales`` is read once.
    """
    sets = [(CHANNEL, key) for key in GRAINS]
    grain = F.coalesce(*[F.when(F.grouping(key) == 0, F.lit(key)) for key in GRAINS])
    return sales.select(CHANNEL, *GRAINS, "total_price", "units", "discount").groupingSets(
        sets, CHANNEL, *GRAINS).agg(
        grain.alias("grain"),
        F.sum("total_price").alias("total_price"), F.sum("units").alias("units"),
        F.sum("discount").alias("discounts"), F.count("*").alias("transactions"),
        F.count("total_price").alias("priced"), F.count("discount").alias("discounted"))


def added(stored: DataFrame) -> DataFrame:
    """The states of several loads as those of all their sales."""
    return stored.groupBy("grain", CHANNEL, *GRAINS).agg(*[F.sum(c).alias(c) for c in SUMS])


def pending(spark: SparkSession, base: str, star: str) -> list[commits.Commit]:
    """Loads committed to the facts below ``star`` that the states do not hold yet."""
    done = {c.info.get("of") for c in commits.Log(spark, base).commits()}
    last = {c.load: c for c in commits.Log(spark, star).commits()
            if model.fact_path(ONLINE) in c.tables}
    return [c for c in last.values() if c.token not in done]


def refresh(spark: SparkSession, base: str, star: str) -> DataFrame | None:
    """Take the loads that the states do not hold yet; returns the states of all loads.

    One commit per load, under the load's id: a load that was repeated replaces its states,
    and a refresh that fails is made good by the next one. Facts of other loads are not
    opened. Stored are the states of single loads, which are added when read. None before
    the first load.
    """
    log, facts = commits.Log(spark, base), commits.Log(spark, star)
    for load in pending(spark, base, star):
        new = {f"{c}_fact": facts.read_load(model.fact_path(c), load.token) for c in (ONLINE, OFFLINE)}
        work = log.begin(load.load)
        work.write(TABLE, states(model.sales(new)))
        work.commit(of=load.token)
    stored = log.read(TABLE)
    return None if stored is None else added(stored)


def _of(table: DataFrame, *grains: str) -> DataFrame:
    return table.where(F.col("grain").isin(*grains))


def _named_mean(table, dim, key, label, total, count, name):
    """Mean by ``key`` of the channel means, as ``marts`` has it."""
    online = F.col(CHANNEL) == ONLINE

    def mean(of):
        return F.sum(F.when(of, F.col(total))) / F.nullif(F.sum(F.when(of, F.col(count))), F.lit(0))

    per_key = _of(table, key).groupBy(key).agg(mean(online).alias("online"), mean(~online).alias("offline"))
    both = (F.col("online") + F.col("offline")) / 2
    means = per_key.select(key, F.coalesce(both, "online", "offline").alias(name))
    return means.join(dim.select(key, label), key).orderBy(F.desc(name), key).select(label, name)


def _freq_customers(table: DataFrame, customer: DataFrame) -> DataFrame:
    counts = _of(table, "customer_key").groupBy("customer_key").agg(
        F.sum("transactions").alias("total_transactions"))
    named = counts.join(customer.select("customer_key", "customer_name"), "customer_key")
    return named.orderBy(F.desc("total_transactions"), "customer_key").select(
        "customer_name", "total_transactions")


def _places(table: DataFrame) -> DataFrame:
    """Online sales by state and offline sales by branch, each sale once."""
    online = F.col(CHANNEL) == ONLINE
    return table.where(((F.col("grain") == "shipping_state") & online)
                       | ((F.col("grain") == "branch_key") & ~online))


def build(table: DataFrame, star: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The fifteen marts by name from the states, which the caller has stored.

    Sums of states are sums of sales, so the marts of sums are those of ``marts`` itself.
    """
    date, product, customer = star["date"], star["product"], star["customer"]
    branch, agent = star["branch"], star["sales_agent"]
    by_date, by_product = _of(table, "date_key"), _of(table, "product_key")
    by_customer = _of(table, "customer_key")
    return {
        "total_monthly_sales": marts.total_monthly_sales(by_date, date),
        "total_product_sales": marts.total_product_sales(by_product, product),
        "total_payment_method_sales": marts.total_payment_method_sales(_of(table, "payment_method")),
        "total_customer_sales": marts.total_customer_sales(by_customer, customer),
        "branch_sales": marts.branch_sales(_of(table, "branch_key"), branch),
        "agent_sales": marts.agent_sales(_of(table, "sales_agent_key"), agent),
        "top_products": marts.top_products(by_product, product),
        "discount_by_product": _named_mean(
            table, product, "product_key", "product_name", "discounts", "discounted", "average_discount"),
        "total_sales_trend": marts.total_sales_trend(by_date, date),
        "total_category_sales": marts.total_category_sales(by_product, product),
        "avg_sales_per_customer": _named_mean(
            table, customer, "customer_key", "customer_name", "total_price", "priced", "average_sales"),
        "freq_customers": _freq_customers(table, customer),
        "total_sales_by_state": marts.total_sales_by_state(_places(table), branch),
        "clv": marts.clv(by_customer, customer),
        "monthly_sales": marts.monthly_sales(by_date, date),
    }
