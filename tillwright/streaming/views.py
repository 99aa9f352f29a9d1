"""Windowed views of purchases.

Every function takes decoded events, as a stream or as a table; on a table the
watermark has no effect and all windows come out. On a stream a window comes out
once, when the watermark passes its end. Grouping is pre-aggregated in each task
before the shuffle, so a product or customer with a third of the events sends
one partial row per task and window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.functions.measures import segment

# How late an event may come, and the window length, by view.
HOURLY = ("2 hours", "1 hour")
DAILY = ("48 hours", "1 day")
MONTHLY = ("30 days", "30 days")


def _per_window(
    events: DataFrame, timing: tuple[str, str], key: Column, *measures: Column
) -> DataFrame:
    """Measures of the purchases by key and window, window bounds as columns.

    Only purchases advance the watermark. Written the other way round, the
    optimizer moves the filter below the watermark anyway.
    """
    delay, length = timing
    purchases = events.where(F.col("eventType") == "purchase").withWatermark("timestamp", delay)
    grouped = purchases.groupBy(key, F.window("timestamp", length)).agg(*measures)
    bounds = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
    first, *rest = [c for c in grouped.columns if c != "window"]
    return grouped.select(first, *bounds, *rest)


def _amounts(count: str, total: str, mean: str) -> list[Column]:
    return [
        F.count("*").alias(count),
        F.sum("totalAmount").alias(total),
        F.avg("totalAmount").alias(mean),
    ]


def hourly_sales(events: DataFrame) -> DataFrame:
    return _per_window(events, HOURLY, F.col("productId"),
                       *_amounts("num_purchases", "total_sales", "avg_sale_value"))


def category_performance(events: DataFrame) -> DataFrame:
    """Sales by category. Purchases as produced carry no category, so expect null."""
    return _per_window(events, HOURLY, F.col("metadata.category").alias("category"),
                       *_amounts("num_purchases", "total_sales", "avg_sale_value"),
                       F.approx_count_distinct("customerId").alias("unique_customers"))


def payment_method_trends(events: DataFrame) -> DataFrame:
    return _per_window(events, DAILY, F.col("paymentMethod"),
                       *_amounts("num_transactions", "total_amount", "avg_transaction_value"))


def customer_segmentation(events: DataFrame) -> DataFrame:
    spending = _per_window(events, MONTHLY, F.col("customerId"),
                           F.count("*").alias("purchase_frequency"),
                           F.sum("totalAmount").alias("total_spend"))
    return spending.withColumn("segment", segment("purchase_frequency", "total_spend"))


def product_inventory(events: DataFrame) -> DataFrame:
    """Units sold by product."""
    return _per_window(events, HOURLY, F.col("productId"),
                       F.sum("quantity").alias("quantity_sold"))


VIEWS = {
    "hourly_sales": hourly_sales,
    "category_performance": category_performance,
    "payment_method_trends": payment_method_trends,
    "customer_segmentation": customer_segmentation,
    "product_inventory": product_inventory,
}
