"""Rows sent again, and marts refreshed month by month, against full rebuilds."""

from __future__ import annotations

import random
from datetime import date
from decimal import Decimal
from pathlib import Path
from uuid import uuid4

import pytest
from fixtures import Shop, line, order, product, rows_of, table

from tallyloom.model import SOURCES, Schemas
from tallyloom.plans import incremental, marts, rollups, warehouse
from tallyloom.plans.current import build_current, current_rows
from tallyloom.sources.csv_files import FileDrop
from tallyloom.streaming import landing


@pytest.fixture
def schemas(spark):
    made = Schemas.prefixed(f"t{uuid4().hex[:8]}")
    yield made
    for name in (made.raw, made.silver, made.gold, made.work):
        spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


# Rows sent again


def written(rows) -> str:
    return "\n".join(["h", *[",".join("NULL" if v is None else str(v) for v in row) for row in rows]]) + "\n"


class Delivered:
    def __init__(self, spark, folder: Path, schemas: Schemas):
        self.spark, self.folder, self.schemas = spark, folder, schemas
        landing.create_raw_tables(spark, str(folder / "landed"), schemas)

    def send(self, stamp: str, **tables):
        for name, rows in tables.items():
            (self.folder / "in" / name).mkdir(parents=True, exist_ok=True)
            (self.folder / "in" / name / f"{name}__{stamp}.csv").write_text(written(rows))
        drop = FileDrop(str(self.folder / "in"))
        landing.land(self.spark, drop, str(self.folder / "landed"), str(self.folder / "cp"), schemas=self.schemas)


SHOP = {
    "client": [("1", "Ada", "a@b.example", "5550001", "12 St", 1, 1, "2020-01-01")],
    "client_type": [(1, "Standard")],
    "client_status": [(1, "Active")],
    "orders": [order(1), order(2, day="2024-07-01")],
    "order_product": [line(1, 1), line(2, 1, quantity="2.0"), line(3, 2)],
    "product": [product(1)],
    "payment_method": [(1, "card")],
}


def marts_of(spark, schemas):
    return {n: sorted(map(str, warehouse.gold_table(spark, n, schemas).collect())) for n in warehouse.MART_TABLES}


def test_a_delivery_sent_twice_leaves_all_marts_unchanged(spark, tmp_path, schemas):
    shop = Delivered(spark, tmp_path, schemas)
    current = Schemas(f"{schemas.raw}_now", schemas.silver, schemas.gold, schemas.work)
    try:
        shop.send("2025_22_03_13_50", **SHOP)
        build_current(spark, schemas, current)
        warehouse.build(spark, schemas=current)
        before = marts_of(spark, schemas)
        shop.send("2025_22_04_13_50", **SHOP)
        assert landing.landed_rows(spark, str(tmp_path / "landed"), "orders").count() == 4
        for _ in range(2):  # a build that is repeated changes nothing either
            build_current(spark, schemas, current)
            warehouse.build(spark, schemas=current)
            assert marts_of(spark, schemas) == before
        assert warehouse.check(spark, schemas).filter("not passed").isEmpty()
    finally:
        spark.sql(f"DROP SCHEMA IF EXISTS {current.raw} CASCADE")


def test_what_was_delivered_last_counts_whenever_it_was_loaded(spark, tmp_path, schemas):
    shop = Delivered(spark, tmp_path, schemas)
    shop.send("2025_01_05_08_00", orders=[order(1, status="new"), order(2)])  # the first of May
    shop.send("2025_30_04_08_00", orders=[order(1, status="old"), order(3), (None, *order(9)[1:]), (None, *order(9)[1:])])
    shop.send("2025_02_05_08_00", orders=[(4, "bad", 1, "2024-01-01", "x", "1.00"), (2, *order(2)[1:5], None)])
    rows = current_rows(spark.table(f"{schemas.raw}.orders"), "orders")
    assert rows.schema == SOURCES["orders"]
    assert rows_of(rows, "order_id", "status", "total_amount") == [
        (None, "Pending", Decimal("10.00")), (None, "Pending", Decimal("10.00")),
        (1, "new", Decimal("10.00")), (2, "Pending", None), (3, "Pending", Decimal("10.00")),
    ]


def test_nothing_landed_gives_empty_current_tables(spark, tmp_path, schemas):
    Delivered(spark, tmp_path, schemas)
    assert current_rows(spark.table(f"{schemas.raw}.orders"), "orders").collect() == []


# Month by month


def full(shop) -> dict[str, list]:
    fact = shop.fact
    sales = rollups.order_sales(fact)
    by_category = incremental.sales_by_category_month(rollups.category_sales(fact, shop.dim_product))
    return {incremental.MONTHLY: rows_of(marts.mart_monthly_sales(sales), *MONTHLY), incremental.BY_CATEGORY: rows_of(by_category, *BY_CATEGORY)}


MONTHLY = ("month", "total_orders", "total_units_sold", "total_revenue", "avg_order_value")
BY_CATEGORY = ("category", "month", "total_orders", "total_units_sold", "total_revenue")


def refreshed(spark, shop, changed, schemas):
    months = incremental.refresh(table(spark, "orders", changed), shop.orders, shop.order_product, shop.product, schemas)
    stored = {
        incremental.MONTHLY: rows_of(incremental.stored(spark, incremental.MONTHLY, schemas), *MONTHLY),
        incremental.BY_CATEGORY: rows_of(incremental.stored(spark, incremental.BY_CATEGORY, schemas), *BY_CATEGORY),
    }
    return months, stored


def files_of(spark, schemas):
    """Path and time of the files of every stored month."""
    out = {}
    for name in incremental.TABLES:
        rows = incremental.stored(spark, name, schemas)
        for r in rows.select("month", "_metadata.file_path", "_metadata.file_modification_time").distinct().collect():
            out.setdefault((name, r.month), set()).add((r.file_path, r.file_modification_time))
    return out


def test_refreshes_equal_a_full_build_and_leave_other_months_alone(spark, schemas):
    rng = random.Random(4)
    products = [product(1, "Books"), product(2, "Toys"), product(3, None)]
    days = [f"2024-{m:02d}-{d:02d}" for m in range(1, 7) for d in (1, 15)]
    orders = {i: order(i, day=rng.choice(days)) for i in range(60)}
    lines = [line(3 * i + k, i, rng.randint(1, 3), f"{k + 1}.5") for i in range(70) for k in range(2)]
    shop = Shop(spark, orders=list(orders.values()), order_product=lines, product=products)
    months, stored = refreshed(spark, shop, list(orders.values()), schemas)
    assert months == [date(2024, m, 1) for m in range(1, 7)] and stored == full(shop)
    before = files_of(spark, schemas)

    # New orders of one month, and one that moves between two others.
    moved = next(i for i, o in orders.items() if o[3].month == 2)
    changed = [order(i, day="2024-05-20") for i in range(60, 65)] + [order(moved, day="2024-04-02")]
    orders |= {o[0]: o for o in changed}
    shop = Shop(spark, orders=list(orders.values()), order_product=lines, product=products)
    months, stored = refreshed(spark, shop, changed, schemas)
    assert [m.month for m in months] == [2, 4, 5] and stored == full(shop)
    after = files_of(spark, schemas)
    for (name, month), files in before.items():
        assert (after[name, month] == files) == (month.month in (1, 3, 6)), (name, month)

    # A refresh that is repeated, and one without changes.
    assert refreshed(spark, shop, changed, schemas)[1] == stored
    assert refreshed(spark, shop, [], schemas) == ([], stored)


def test_months_that_lose_all_rows_go_and_rows_without_a_date_stay(spark, schemas):
    undated = (3, 1, 1, None, "Pending", Decimal("1.00"))
    orders = [order(1, day="2024-06-15"), order(2, day="2024-07-15"), undated]
    lines = [line(i, i) for i in (1, 2, 3)]
    shop = Shop(spark, orders=orders, order_product=lines)
    months, stored = refreshed(spark, shop, orders, schemas)
    assert months == [None, date(2024, 6, 1), date(2024, 7, 1)] and stored == full(shop)
    orders = [order(1, day="2024-08-01"), order(2, day="2024-07-15"), order(3, day="2024-08-02")]
    shop = Shop(spark, orders=orders, order_product=lines)
    months, stored = refreshed(spark, shop, [orders[0], orders[2]], schemas)
    assert months == [None, date(2024, 6, 1), date(2024, 8, 1)] and stored == full(shop)
    assert [row[0] for row in stored[incremental.MONTHLY]] == [date(2024, 7, 1), date(2024, 8, 1)]


def test_the_first_refresh_of_nothing_and_of_orders_without_lines(spark, schemas):
    shop = Shop(spark)
    assert incremental.refresh(shop.orders, shop.orders, shop.order_product, shop.product, schemas) == []
    shop = Shop(spark, orders=[order(1)])
    months, stored = refreshed(spark, shop, [order(1)], schemas)
    assert months == [date(2024, 6, 1)] and stored == {incremental.MONTHLY: [], incremental.BY_CATEGORY: []}
