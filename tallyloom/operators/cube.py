"""Two-way sales cubes with distinct order counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.measures import REVENUE, UNITS, total_revenue, total_units


def sales_cube(sales: DataFrame, row: str, column: str, key: str = "order_id") -> DataFrame:
    """``CUBE(row, column)`` with orders, units and revenue, for large inputs.

    Distinct counts do not add up, so a plain cube must expand its whole input four
    times and shuffle every copy. Here each (key, row, column) combination is kept once
    and marked when it is the first of its key overall, within its row value and within
    its column value. Counting marks does add up: the input is reduced to one small
    table of cells, and only the cells are cubed.

    All three windows are clustered by ``key``, so they share one shuffle, or none if
    the input is already partitioned by it. A key with very many lines is reduced on
    the map side to its combinations first.
    """
    distinct = sales.groupBy(key, row, column).agg(
        F.sum("units").alias("units"), F.sum("revenue").alias("revenue")
    )
    # The window by key alone comes first: the shuffle it asks for serves the others.
    overall = Window.partitionBy(key).orderBy(row, column)
    within_row = Window.partitionBy(key, row).orderBy(column)
    within_column = Window.partitionBy(key, column).orderBy(row)
    marked = (
        distinct.withColumn("nth", F.row_number().over(overall))
        .withColumn("nth_in_row", F.row_number().over(within_row))
        .withColumn("nth_in_column", F.row_number().over(within_column))
    )
    known = F.col(key).isNotNull()
    cells = marked.groupBy(row, column).agg(
        F.count(key).alias("orders"),
        F.count_if(known & (F.col("nth_in_row") == 1)).alias("row_orders"),
        F.count_if(known & (F.col("nth_in_column") == 1)).alias("column_orders"),
        F.count_if(known & (F.col("nth") == 1)).alias("all_orders"),
        F.sum("units").alias("units"),
        F.sum("revenue").alias("revenue"),
    )
    level = F.grouping_id()
    orders = (
        F.when(level == 0, F.sum("orders"))
        .when(level == 1, F.sum("row_orders"))
        .when(level == 2, F.sum("column_orders"))
        .otherwise(F.sum("all_orders"))
    )
    return cells.cube(row, column).agg(
        orders.alias("total_orders"),
        total_units().alias("total_units_sold"),
        total_revenue().alias("total_revenue"),
    )


def sales_cube_plain(sales: DataFrame, row: str, column: str, key: str = "order_id") -> DataFrame:
    """The same cube in Spark's direct form; the yardstick for :func:`sales_cube`."""
    return sales.cube(row, column).agg(
        F.count_distinct(key).alias("total_orders"),
        F.sum("units").cast(UNITS).alias("total_units_sold"),
        F.sum("revenue").cast(REVENUE).alias("total_revenue"),
    )


def label_subtotals(cube: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Replace the NULL of a subtotal by a label.

    A NULL key in the data gets the same label, beside the real subtotal.
    """
    return cube.select(
        *[
            F.coalesce(F.col(name).cast("string"), F.lit(labels[name])).alias(name)
            if name in labels
            else F.col(name)
            for name in cube.columns
        ]
    )
