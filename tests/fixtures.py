"""Small hand-made source tables. Rows are tuples in declared column order."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from tallyloom.model import SOURCES
from tallyloom.plans import star

JOINED = datetime(2020, 5, 10)


def table(spark, name, rows):
    return spark.createDataFrame(rows, SOURCES[name])


def client(client_id, type_id=1, status_id=1, **changes):
    row = {
        "client_id": client_id,
        "client_name": f"Client {client_id}",
        "email": f"c{client_id}@mail.example",
        "phone_number": "(555) 000-0001",
        "address": "12 Sample St",
        "type_id": type_id,
        "status_id": status_id,
        "registration_date": JOINED,
    }
    return tuple((row | changes).values())


def order(order_id, client_id=1, payment_id=1, day="2024-06-15", status="Pending"):
    return (order_id, client_id, payment_id, date.fromisoformat(day), status, Decimal("10.00"))


def line(line_id, order_id, product_id=1, quantity="1.0", price="10.00"):
    return (
        line_id,
        order_id,
        product_id,
        None if quantity is None else Decimal(quantity),
        None if price is None else Decimal(price),
    )


def product(product_id, category="Books", price="10.00"):
    return (product_id, f"Product {product_id}", category, Decimal(price))


class Shop:
    """Source tables with usable defaults, and the star schema over them."""

    def __init__(self, spark, **rows):
        defaults = {
            "client": [client(1)],
            "client_type": [(1, "Standard"), (2, "Premium")],
            "client_status": [(1, "Active")],
            "orders": [],
            "order_product": [],
            "product": [product(1)],
            "payment_method": [(1, "card"), (2, "transfer")],
        }
        tables = defaults | rows
        self.sources = {name: table(spark, name, tables[name]) for name in SOURCES}
        for name, frame in self.sources.items():
            setattr(self, name, frame)
        self.dim_client = star.dim_client(self.client, self.client_type, self.client_status)
        self.dim_product = star.dim_product(self.product)
        self.dim_payment = star.dim_payment(self.payment_method)
        self.fact = star.fact_orders(self.orders, self.order_product)

    def models(self):
        return {f"stg_{name}": frame for name, frame in self.sources.items()} | {
            "dim_client": self.dim_client,
            "dim_product": self.dim_product,
            "dim_payment": self.dim_payment,
            "fact_orders": self.fact,
        }


def rows_of(df, *columns):
    """Rows as tuples, in the columns given, sorted with NULL first."""
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted(
        (tuple(row) for row in rows), key=lambda r: [(v is not None, str(v)) for v in r]
    )
