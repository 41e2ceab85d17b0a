"""Monthly tables that are refreshed month by month instead of rebuilt in full.

The fact, the monthly mart and the sales by category and month are stored in one partition a
month. A refresh finds the months a change touches, computes these alone and overwrites
their partitions; the files of all other months stay as they are. The result is that of a
full build, whatever the order of the refreshes, and a refresh that died may be repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.measures import month_of, total_revenue, total_units
from tallyloom.model import DESCRIPTIONS, SCHEMAS, Schemas
from tallyloom.plans import marts, rollups, star
from tallyloom.plans.warehouse import location

FACT = "monthly_fact_orders"
MONTHLY = "monthly_sales"
BY_CATEGORY = "monthly_category_sales"
TABLES = (FACT, MONTHLY, BY_CATEGORY)


def sales_by_category_month(category_sales: DataFrame) -> DataFrame:
    """Orders, units and revenue of every category in every month it sold in."""
    return category_sales.groupBy("category", month_of(F.col("order_date")).alias("month")).agg(
        F.count_distinct("order_id").alias("total_orders"),
        total_units().alias("total_units_sold"),
        total_revenue().alias("total_revenue"),
    )


def in_months(column: Column, months: Sequence[date | None]) -> Column:
    """Literal months, NULL among them, so that other partitions are not even listed."""
    some = column.isin([m for m in months if m is not None])
    return some | column.isNull() if None in months else some


def touched_months(spark: SparkSession, changed: DataFrame, schemas: Schemas = SCHEMAS) -> list[date | None]:
    """The months of the changed orders, and those the fact has them in so far.

    ``changed`` has (order_id, order_date): orders that are new, were sent again, or whose lines
    changed. As many months as the calendar has reach the driver, however many orders changed.
    """
    months = changed.select(month_of(F.col("order_date")).alias("month")).distinct()
    if spark.catalog.tableExists(f"{schemas.work}.{FACT}"):
        before = spark.table(f"{schemas.work}.{FACT}").select("order_id", "month")
        before = before.join(changed.select("order_id").distinct(), "order_id", "left_semi")
        months = months.unionByName(before.select("month")).distinct()
    return sorted((row.month for row in months.collect()), key=lambda m: (m is not None, m or date.min))


def _overwrite_months(name: str, df: DataFrame, months: Sequence[date | None], schemas: Schemas) -> None:
    """Replace the partitions of these months; those that have no rows any more go."""
    spark = df.sparkSession
    table = f"{schemas.work}.{name}"
    # The partition column comes last, as stored.
    columns = [*[c for c in df.columns if c != "month"], "month"]
    df = df.select(*columns)
    if not spark.catalog.tableExists(table):
        empty = spark.createDataFrame([], df.schema)
        empty.write.partitionBy("month").format("parquet").saveAsTable(table)
        spark.sql(f"COMMENT ON TABLE {table} IS '{DESCRIPTIONS[name]}'")
    # Few files a month, but a large month is shared among tasks.
    seen = Observation()
    name_of = F.coalesce(F.col("month").cast("string"), F.lit("NULL"))
    df = df.hint("rebalance", "month").observe(seen, F.collect_set(name_of).alias("months"))
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(
        location(spark, table)
    )
    spark.catalog.recoverPartitions(table)
    written = set(seen.get["months"])
    for month in months:
        if ("NULL" if month is None else str(month)) not in written:
            value = "NULL" if month is None else f"DATE '{month}'"
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (month = {value})")
    spark.catalog.refreshTable(table)


def refresh_months(
    orders: DataFrame,
    order_product: DataFrame,
    product: DataFrame,
    months: Sequence[date | None],
    schemas: Schemas = SCHEMAS,
) -> None:
    """Compute the months from all orders and lines as they are now, and replace them.

    Only orders of these months are read on to the join; both marts read the new partitions
    of the fact, no other ones.
    """
    spark = orders.sparkSession
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schemas.work}")
    if not months:
        return
    dated = orders.filter(in_months(month_of(F.col("order_date")), months))
    fact = star.fact_orders(dated, order_product).withColumn("month", month_of(F.col("order_date")))
    _overwrite_months(FACT, fact, months, schemas)
    stored = spark.table(f"{schemas.work}.{FACT}").filter(in_months(F.col("month"), months))
    sales = rollups.order_sales(stored)
    _overwrite_months(MONTHLY, marts.mart_monthly_sales(sales), months, schemas)
    by_category = sales_by_category_month(rollups.category_sales(stored, product))
    _overwrite_months(BY_CATEGORY, by_category, months, schemas)


def refresh(
    changed: DataFrame,
    orders: DataFrame,
    order_product: DataFrame,
    product: DataFrame,
    schemas: Schemas = SCHEMAS,
) -> list[date | None]:
    """Refresh the months the changed orders touch, and return them. On the first run all
    orders are changed."""
    months = touched_months(orders.sparkSession, changed, schemas)
    refresh_months(orders, order_product, product, months, schemas)
    return months


def stored(spark: SparkSession, name: str, schemas: Schemas = SCHEMAS) -> DataFrame:
    return spark.table(f"{schemas.work}.{name}")
