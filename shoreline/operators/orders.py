"""Order aggregates attached to customers and products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_customer(orders: DataFrame) -> DataFrame:
    """Order totals per customer. Order dates are ISO text; the latest one is taken as a
    date, a fixed-width value that the aggregation can keep in its hash table."""
    latest = F.max(F.col("order_date").try_cast("date"))
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("total_amount").alias("total_order_value"),
        F.date_format(latest, "yyyy-MM-dd").alias("latest_order_date"),
        F.avg("total_amount").alias("avg_order_value"),
    )


def by_customer_wide(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("total_amount").alias("total_spent"),
    )


def by_product(orders: DataFrame) -> DataFrame:
    return orders.groupBy("product_id").agg(
        F.sum("quantity").alias("total_quantity_sold"),
        F.count("order_id").alias("total_orders"),
        F.sum("total_amount").alias("total_sales_value"),
    )


def by_product_wide(orders: DataFrame) -> DataFrame:
    return orders.groupBy("product_id").agg(
        F.count("order_id").alias("orders_count"),
        F.sum("quantity").alias("units_sold"),
    )
