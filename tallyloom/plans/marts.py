"""Gold layer, marts: sales by month, category, client and client type, and two cubes.

Every mart reads a rollup (see :mod:`tallyloom.plans.rollups`). Results are not sorted;
:func:`tallyloom.plans.extracts.in_display_order` sorts them for reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.measures import (
    REVENUE,
    UNITS,
    average_per_count,
    average_per_unit,
    month_of,
    total_revenue,
    total_units,
)
from tallyloom.operators.cube import label_subtotals, sales_cube

# Subtotal labels that readers of the cubes filter by.
CATEGORY_MONTH_LABELS = {"category": "ALL CATEGORIES", "month": "ALL MONTHS"}
PAYMENT_STATUS_LABELS = {"payment_method": "ALL METHODS", "order_status": "ALL STATUSES"}


def mart_monthly_sales(sales: DataFrame) -> DataFrame:
    totals = sales.groupBy(month_of(F.col("order_date")).alias("month")).agg(
        F.count_distinct("order_id").alias("total_orders"),
        total_units().alias("total_units_sold"),
        total_revenue().alias("total_revenue"),
    )
    average = average_per_count(F.col("total_revenue"), F.col("total_orders"))
    return totals.withColumn("avg_order_value", average)


def mart_sales_by_category(category_sales: DataFrame) -> DataFrame:
    totals = category_sales.groupBy("category").agg(
        F.count_distinct("order_id").alias("total_orders"),
        total_units().alias("total_units_sold"),
        total_revenue().alias("total_revenue"),
    )
    average = average_per_unit(F.col("total_revenue"), F.col("total_units_sold"))
    return totals.withColumn("avg_price_per_unit", average)


def mart_sales_by_client_type(sales: DataFrame, client: DataFrame) -> DataFrame:
    """Orders of unknown clients drop out; clients without a type form a NULL group.

    Sales are added up per client before the join, so it sees one row per client. Orders add
    up too where all rows of an order have one client, of which the first is marked; orders
    spread over several clients (none, if order ids are unique) are counted apart, as distinct
    ids per type. A client id that occurs in several dimension rows of one type counts
    its orders once and its revenue once a row, as grouping after the join would.
    """
    by_order = Window.partitionBy("order_id")
    marked = sales.select(
        "order_id",
        "client_id",
        "revenue",
        # Rows without a client come last, so the first row has one if any has.
        F.row_number().over(by_order.orderBy(F.asc_nulls_last("client_id"))).alias("nth"),
        F.min("client_id").over(by_order).alias("low"),
        F.max("client_id").over(by_order).alias("high"),
    )
    whole = F.col("order_id").isNotNull() & (F.col("low") == F.col("high"))
    per_client = marked.groupBy("client_id").agg(
        F.count_if(whole & (F.col("nth") == 1)).alias("orders"),
        F.sum("revenue").alias("revenue"),
    )
    types = client.groupBy("client_id", F.col("type_name").alias("client_type")).agg(
        F.count("*").alias("copies")
    )
    totals = (
        per_client.join(types, "client_id")
        .groupBy("client_type")
        .agg(
            F.count("client_id").alias("total_clients"),
            F.sum("orders").alias("orders"),
            F.sum(F.col("revenue") * F.col("copies")).alias("revenue"),
        )
    )
    spread = marked.filter("order_id is not null and client_id is not null and low < high")
    spread = (
        spread.select("order_id", "client_id")
        .join(types, "client_id")
        .groupBy("client_type")
        .agg(F.count_distinct("order_id").alias("more"))
    )
    same = totals.client_type.eqNullSafe(spread.client_type)
    totals = totals.join(spread, same, "left").select(
        totals.client_type,
        "total_clients",
        (F.col("orders") + F.coalesce("more", F.lit(0))).alias("total_orders"),
        F.col("revenue").cast(REVENUE).alias("total_revenue"),
    )
    average = average_per_count(F.col("total_revenue"), F.col("total_clients"))
    return totals.withColumn("revenue_per_client", average)


def mart_sales_by_client(sales: DataFrame, client: DataFrame) -> DataFrame:
    """Sales per client; clients without orders and orders of unknown clients drop out.

    Sales are added up per client id before the join, so the join sees one row per
    client however many orders one of them has. The second aggregate only matters if a
    client id occurs in several dimension rows; it then merges those that look alike,
    as grouping after the join would. It needs no further shuffle.
    """
    per_client = sales.groupBy("client_id").agg(
        F.count_distinct("order_id").alias("orders"),
        F.sum("units").alias("units"),
        F.sum("revenue").alias("revenue"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
    )
    names = client.select(
        "client_id",
        "client_name",
        F.col("type_name").alias("client_type"),
        F.col("status_name").alias("client_status"),
    )
    return (
        per_client.join(names, "client_id")
        .groupBy("client_id", "client_name", "client_type", "client_status")
        .agg(
            F.max("orders").alias("total_orders"),
            F.sum("units").cast(UNITS).alias("total_units_sold"),
            F.sum("revenue").cast(REVENUE).alias("total_revenue"),
            F.min("first_date").alias("first_order_date"),
            F.max("last_date").alias("last_order_date"),
        )
    )


def mart_cube_category_month(category_sales: DataFrame) -> DataFrame:
    monthly = category_sales.withColumn("month", month_of(F.col("order_date")))
    return label_subtotals(sales_cube(monthly, "category", "month"), CATEGORY_MONTH_LABELS)


def mart_cube_payment_status(sales: DataFrame, payment: DataFrame) -> DataFrame:
    paid = sales.join(payment, "payment_id").withColumnRenamed("status", "order_status")
    return label_subtotals(
        sales_cube(paid, "payment_method", "order_status"), PAYMENT_STATUS_LABELS
    )
