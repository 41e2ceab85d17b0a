"""Sales reduced to the grain the marts need.

The marts count distinct orders and add up units and revenue, so lines may be added up
per order before anything else happens to them. A rollup has one row per order (and
category) instead of one per line. Its sums are exact, and an order with a huge number
of lines is reduced on the map side, before any shuffle.

Each rollup comes in two forms with equal totals: from the stored fact, which needs no
join to the orders, and straight from orders and lines, where the reduction happens
below that join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.measures import line_revenue

ORDER_COLUMNS = ("order_id", "client_id", "payment_id", "order_date", "status")


def _measures() -> list:
    return [F.sum("quantity").alias("units"), F.sum(line_revenue()).alias("revenue")]


def order_sales(fact: DataFrame) -> DataFrame:
    """Units and revenue per order, with the order's attributes."""
    return fact.groupBy(*ORDER_COLUMNS).agg(*_measures())


def order_sales_from_lines(orders: DataFrame, order_product: DataFrame) -> DataFrame:
    per_order = order_product.groupBy("order_id").agg(*_measures())
    return per_order.join(orders.select(*ORDER_COLUMNS), "order_id")


def category_sales(fact: DataFrame, product: DataFrame) -> DataFrame:
    """Units and revenue per order and product category, with the order date."""
    return (
        fact.join(product.select("product_id", "category"), "product_id")
        .groupBy("order_id", "order_date", "category")
        .agg(*_measures())
    )


def category_sales_from_lines(
    orders: DataFrame, order_product: DataFrame, product: DataFrame
) -> DataFrame:
    per_order = (
        order_product.join(product.select("product_id", "category"), "product_id")
        .groupBy("order_id", "category")
        .agg(*_measures())
    )
    return per_order.join(orders.select("order_id", "order_date"), "order_id")
