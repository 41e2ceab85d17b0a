"""Small result tables for a dashboard, read from the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.measures import (
    REVENUE,
    UNITS,
    money_text,
    month_label,
    share_percent,
)
from tallyloom.plans.marts import CATEGORY_MONTH_LABELS, PAYMENT_STATUS_LABELS


def kpi_totals(sales: DataFrame) -> DataFrame:
    """Orders, clients, units and revenue overall; one row, with NULL sums if there are no sales.

    The first row of each order is marked, for which sales need no shuffle if they are clustered
    by order already. Marks add up, so only one row per client is shuffled to count clients.
    """
    nth = F.row_number().over(Window.partitionBy("order_id").orderBy("client_id"))
    per_client = (
        sales.withColumn("nth", nth)
        .groupBy("client_id")
        .agg(
            F.count_if(F.col("order_id").isNotNull() & (F.col("nth") == 1)).alias("orders"),
            F.sum("units").alias("units"),
            F.sum("revenue").alias("revenue"),
        )
    )
    return per_client.agg(
        F.coalesce(F.sum("orders"), F.lit(0)).cast("bigint").alias("orders"),
        F.count("client_id").alias("clients"),
        F.sum("units").cast(UNITS).alias("units"),
        F.sum("revenue").cast(REVENUE).alias("revenue"),
    )


def kpi_cards(totals: DataFrame) -> DataFrame:
    """The totals as display text."""
    return totals.select(
        money_text(F.col("revenue")).alias("total_revenue"),
        F.format_number("orders", 0).alias("total_orders"),
        F.format_number("clients", 0).alias("unique_clients"),
        F.format_number("units", 0).alias("units_sold"),
    )


def _subtotals_last(labels: dict[str, str]) -> list[Column]:
    order = []
    for name, label in labels.items():
        order += [(F.col(name) == label).asc(), F.col(name).asc()]
    return order


def in_display_order(mart: str, df: DataFrame) -> DataFrame:
    """A mart sorted for reading; stored marts have no order."""
    best_first = F.desc("total_revenue")
    orders: dict[str, list[Column]] = {
        "mart_monthly_sales": [F.asc("month")],
        "mart_sales_by_category": [best_first, F.asc_nulls_last("category")],
        "mart_sales_by_client_type": [best_first, F.asc_nulls_last("client_type")],
        "mart_sales_by_client": [best_first, F.asc("client_id")],
        "mart_cube_category_month": _subtotals_last(CATEGORY_MONTH_LABELS),
        "mart_cube_payment_status": _subtotals_last(PAYMENT_STATUS_LABELS),
    }
    return df.orderBy(*orders[mart])


def _labelled(chart: DataFrame) -> DataFrame:
    """With the revenue in whole dollars, as charts write it beside a mark."""
    return chart.withColumn("revenue_label", money_text(F.col("total_revenue"), 0))


def monthly_sales_series(monthly: DataFrame) -> DataFrame:
    series = monthly.select(
        "month", month_label(F.col("month")).alias("month_label"), "total_revenue"
    )
    return _labelled(series).orderBy("month")


def category_revenue_share(by_category: DataFrame) -> DataFrame:
    """Revenue per category and its percentage of the revenue of all categories.

    The total is a window over the mart, which is one row a category: the plan holds the mart once.
    """
    whole = F.sum("total_revenue").over(Window.partitionBy()).alias("whole")
    totals = by_category.select("category", "total_revenue", whole)
    share = share_percent(F.col("total_revenue"), F.col("whole")).alias("share_pct")
    return _labelled(totals.select("category", "total_revenue", share))


def client_type_revenue(by_client_type: DataFrame) -> DataFrame:
    return _labelled(by_client_type.select("client_type", "total_revenue"))


def _without_subtotals(cube: DataFrame, labels: dict[str, str]) -> DataFrame:
    # Filters by label text, so a NULL key in the data, which has the label too, is left out.
    for name, label in labels.items():
        cube = cube.filter(F.col(name) != label)
    return cube


def cells_category_month(cube: DataFrame) -> DataFrame:
    return _without_subtotals(cube, CATEGORY_MONTH_LABELS)


def cells_payment_status(cube: DataFrame) -> DataFrame:
    return _without_subtotals(cube, PAYMENT_STATUS_LABELS)


def heatmap_series(cells: DataFrame) -> DataFrame:
    """Cells in long form, with the month as a date and as a label such as ``Jun 2024``."""
    month = F.to_date("month")
    series = cells.select(
        "category", month.alias("month"), month_label(month).alias("month_label"), "total_revenue"
    )
    return _labelled(series)


def sold_months(cells: DataFrame) -> list[str]:
    """The months with sales, in order. As many as the calendar has, however large the data."""
    return [row.month for row in cells.select("month").distinct().orderBy("month").collect()]


def heatmap_category_month(cells: DataFrame, months: Sequence[str]) -> DataFrame:
    """Revenue as a matrix, a row per category and a column per month; NULL where nothing sold."""
    revenue = F.sum("total_revenue").cast(REVENUE)
    return cells.groupBy("category").pivot("month", list(months)).agg(revenue)


def top_clients(by_client: DataFrame, n: int = 10) -> DataFrame:
    """The clients with the highest revenue; of equal ones the lower id comes first."""
    top = (
        by_client.select("client_id", "client_name", "client_type", "total_revenue")
        .orderBy(F.desc("total_revenue"), F.asc("client_id"))
        .limit(n)
    )
    return _labelled(top)
