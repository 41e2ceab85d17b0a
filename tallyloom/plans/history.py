"""Clients as they were: versions from successive deliveries, and sales by what held then."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.masking import mask_address, mask_email, mask_phone
from tallyloom.functions.measures import REVENUE, UNITS
from tallyloom.model import SCHEMAS, SOURCES, Schemas
from tallyloom.operators import versions
from tallyloom.operators.asof import asof_join
from tallyloom.plans.warehouse import store
from tallyloom.sources.csv_files import REJECTED
from tallyloom.sources.deliveries import delivered_at

CLIENT_COLUMNS = tuple(SOURCES["client"].fieldNames())
DELIVERED_AT = "delivered_at"
HISTORY_TABLE = "dim_client_history"


def client_deliveries(landed: DataFrame) -> DataFrame:
    """Landed clients with the time their file was delivered, which its name tells."""
    rows = landed.withColumn(DELIVERED_AT, delivered_at(F.col("source_file")))
    return rows.filter(F.col(REJECTED).isNull()).select(*CLIENT_COLUMNS, DELIVERED_AT)


def client_history(deliveries: DataFrame) -> DataFrame:
    return versions.version_history(deliveries, "client_id", DELIVERED_AT, CLIENT_COLUMNS)


def clients_as_of(history: DataFrame, moment: date | datetime) -> DataFrame:
    return versions.as_of(history, moment)


def sales_as_of(sales: DataFrame, history: DataFrame) -> DataFrame:
    """Sales per order with type and status their client had on the day of the order."""
    return asof_join(
        sales, history, "client_id", "order_date", "valid_from", ["type_id", "status_id", "valid_from"]
    )


def sales_by_type_then(sales: DataFrame, history: DataFrame, client_type: DataFrame) -> DataFrame:
    """Clients, orders, units and revenue by the client type that held on the day of the order.

    Sales are added up per type, client and order before the names of the types are joined.
    Orders of clients not known that day, or of an unknown type, form a NULL group.
    """
    per_client = (
        sales_as_of(sales, history)
        .groupBy("type_id", "client_id")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.sum("units").alias("units"),
            F.sum("revenue").alias("revenue"),
        )
    )
    named = per_client.join(client_type, per_client.type_id == client_type.client_type_id, "left")
    return named.groupBy(F.col("type_name").alias("client_type")).agg(
        F.count_distinct("client_id").alias("total_clients"),
        F.sum("orders").alias("total_orders"),
        F.sum("units").cast(UNITS).alias("total_units_sold"),
        F.sum("revenue").cast(REVENUE).alias("total_revenue"),
    )


def build_history(spark: SparkSession, landed: DataFrame, schemas: Schemas = SCHEMAS) -> DataFrame:
    """Store the history of all landed client deliveries as a gold table, contact data masked.

    A change of what the mask hides is a version, too.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schemas.gold}")
    history = client_history(client_deliveries(landed)).withColumns(
        {
            "email": mask_email(F.col("email")),
            "phone_number": mask_phone(F.col("phone_number")),
            "address": mask_address(F.col("address")),
        }
    )
    return store(HISTORY_TABLE, history, schemas)
