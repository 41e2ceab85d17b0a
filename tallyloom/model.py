"""Names, schemas and declared checks of the warehouse."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The public names a user of the warehouse queries by.
RAW_SCHEMA = "oltp"
SILVER_SCHEMA = "hand_on"
GOLD_SCHEMA = "hand_on_output"

# Rollups the marts are built from; not part of the public layers.
WORK_SCHEMA = "work"


@dataclass(frozen=True)
class Schemas:
    """The catalog schemas of one warehouse."""

    raw: str = RAW_SCHEMA
    silver: str = SILVER_SCHEMA
    gold: str = GOLD_SCHEMA
    work: str = WORK_SCHEMA

    @classmethod
    def prefixed(cls, prefix: str) -> Schemas:
        """Schemas of a second warehouse beside the usual one."""
        return cls(*(f"{prefix}_{name}" for name in (RAW_SCHEMA, SILVER_SCHEMA, GOLD_SCHEMA, WORK_SCHEMA)))


SCHEMAS = Schemas()

# Ids are 64-bit: an integer id in the order system is not limited to 32 bits.
_ID = T.LongType()
_TEXT = T.StringType()
_MONEY = T.DecimalType(10, 2)
_QUANTITY = T.DecimalType(10, 1)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


SOURCES: dict[str, T.StructType] = {
    "client": _schema(
        client_id=_ID,
        client_name=_TEXT,
        email=_TEXT,
        phone_number=_TEXT,
        address=_TEXT,
        type_id=_ID,
        status_id=_ID,
        registration_date=T.TimestampNTZType(),
    ),
    "client_status": _schema(client_status_id=_ID, status_name=_TEXT),
    "client_type": _schema(client_type_id=_ID, type_name=_TEXT),
    "orders": _schema(
        order_id=_ID,
        client_id=_ID,
        payment_id=_ID,
        order_date=T.DateType(),
        status=_TEXT,
        total_amount=_MONEY,
    ),
    "order_product": _schema(
        order_product_id=_ID,
        order_id=_ID,
        product_id=_ID,
        quantity=_QUANTITY,
        price_unit=_MONEY,
    ),
    "product": _schema(product_id=_ID, product_name=_TEXT, category=_TEXT, price=_MONEY),
    "payment_method": _schema(payment_id=_ID, payment_method=_TEXT),
}

# One description per silver and gold relation, stored as its catalog comment.
DESCRIPTIONS: dict[str, str] = {
    "stg_client": "Clients as delivered, one row per client",
    "stg_client_status": "Lookup of client statuses",
    "stg_client_type": "Lookup of client types",
    "stg_orders": "Order headers as delivered",
    "stg_order_product": "Order lines as delivered",
    "stg_product": "Product catalog as delivered",
    "stg_payment_method": "Lookup of payment methods",
    "dim_client": "Clients with type and status names; email, phone and address masked",
    "dim_client_history": "Every version of a client with the interval it held in; contact data masked",
    "dim_product": "Products with category and list price",
    "dim_payment": "Payment methods",
    "fact_orders": "Order lines with the attributes of their order; total_amount repeats",
    "order_sales": "Work table: units and revenue per order",
    "category_sales": "Work table: units and revenue per order and category",
    "mart_monthly_sales": "Orders, units, revenue and average order value per month",
    "mart_sales_by_category": "Orders, units, revenue and average unit price per category",
    "mart_sales_by_client_type": "Clients, orders, revenue and revenue per client by client type",
    "mart_sales_by_client": "Orders, units, revenue and order date range per client",
    "mart_cube_category_month": "Sales by category and month with all subtotals",
    "mart_cube_payment_status": "Sales by payment method and order status with all subtotals",
    "monthly_fact_orders": "Work table: order lines by month, rewritten month by month",
    "monthly_sales": "mart_monthly_sales, stored and refreshed month by month",
    "monthly_category_sales": "Sales by category and month, stored and refreshed month by month",
}

# Primary key of every tested relation: each must be unique and not null.
PRIMARY_KEYS: dict[str, str] = {
    "stg_client": "client_id",
    "stg_client_status": "client_status_id",
    "stg_client_type": "client_type_id",
    "stg_orders": "order_id",
    "stg_order_product": "order_product_id",
    "stg_product": "product_id",
    "stg_payment_method": "payment_id",
    "dim_client": "client_id",
    "dim_product": "product_id",
    "dim_payment": "payment_id",
    "fact_orders": "order_product_id",
}


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


# Foreign keys of the fact: each must be not null and present in its dimension.
FACT = "fact_orders"
FOREIGN_KEYS: tuple[ForeignKey, ...] = (
    ForeignKey("client_id", "dim_client", "client_id"),
    ForeignKey("product_id", "dim_product", "product_id"),
    ForeignKey("payment_id", "dim_payment", "payment_id"),
)


def key_comments(relation: str) -> dict[str, str]:
    """What the catalog says about the key columns of a relation."""
    comments = {}
    if relation in PRIMARY_KEYS:
        comments[PRIMARY_KEYS[relation]] = "Primary key"
    if relation == FACT:
        for key in FOREIGN_KEYS:
            comments[key.column] = f"Foreign key to {key.parent}.{key.parent_column}"
    return comments
