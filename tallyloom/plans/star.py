"""Gold layer, star schema: three dimensions and the order-line fact.

No join carries a broadcast hint. Spark broadcasts a side whose size it knows to be
below its threshold; beyond that the join shuffles and adaptive execution splits hot
keys. A dimension may therefore grow without a change here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.masking import mask_address, mask_email, mask_phone


def dim_client(client: DataFrame, client_type: DataFrame, client_status: DataFrame) -> DataFrame:
    """Clients with type and status by name; contact data masked.

    A client whose type or status is unknown stays, with a NULL name.
    """
    return (
        client.join(client_type, client.type_id == client_type.client_type_id, "left")
        .join(client_status, client.status_id == client_status.client_status_id, "left")
        .select(
            "client_id",
            "client_name",
            mask_email(F.col("email")).alias("email"),
            mask_phone(F.col("phone_number")).alias("phone_number"),
            mask_address(F.col("address")).alias("address"),
            "type_name",
            "status_name",
            "registration_date",
        )
    )


def dim_product(product: DataFrame) -> DataFrame:
    return product.select("product_id", "product_name", "category", "price")


def dim_payment(payment_method: DataFrame) -> DataFrame:
    return payment_method.select("payment_id", "payment_method")


def fact_orders(orders: DataFrame, order_product: DataFrame) -> DataFrame:
    """One row per order line. Orders without lines and lines without an order drop out.

    ``total_amount`` belongs to the order and repeats on its lines: do not sum it.
    """
    return order_product.join(orders, "order_id").select(
        "order_product_id",
        "order_id",
        "client_id",
        "product_id",
        "payment_id",
        "order_date",
        "status",
        "quantity",
        "price_unit",
        "total_amount",
    )
