"""Masking, dimensions and the fact on edge rows."""

from __future__ import annotations

from decimal import Decimal

import pytest
from fixtures import Shop, client, line, order, rows_of
from pyspark.sql import functions as F

from tallyloom.functions.masking import mask_address, mask_email, mask_phone
from tallyloom.functions.measures import money_text, month_label, month_of
from tallyloom.model import SOURCES
from tallyloom.plans import staging


@pytest.mark.parametrize(
    ("mask", "value", "expected"),
    [
        (mask_email, "ada@mail.example", "a***@mail.example"),
        (mask_email, "nodomain", "n***@"),
        (mask_email, "a@b@c", "a***@b"),
        (mask_email, "", "***@"),
        (mask_email, None, None),
        (mask_phone, "(555) 000-0001", "(***) ***-0001"),
        (mask_phone, "42", "(***) ***-42"),
        (mask_phone, None, None),
        (mask_address, "12 Sample St", "12 ***"),
        (mask_address, "7", "7***"),
        (mask_address, None, None),
    ],
)
def test_masking(spark, mask, value, expected):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(mask(F.col("v"))).first()[0] == expected


def test_display_text(spark):
    df = spark.sql("select 1234567.895d as x, date '2024-06-15' as d, 497.5bd as units")
    row = df.select(
        money_text(F.col("x").cast("decimal(10,3)")),
        money_text(F.col("x"), 0),
        F.format_number("units", 0),
        month_label(F.col("d")),
        month_of(F.col("d")).cast("string"),
    ).first()
    assert tuple(row) == ("$1,234,567.90", "$1,234,568", "498", "Jun 2024", "2024-06-01")


def test_staging_selects_declared_columns_in_order(spark):
    for name, source in Shop(spark).sources.items():
        shuffled = source.select(F.lit(1).alias("extra"), *reversed(source.columns))
        assert staging.stage(name, shuffled).columns == SOURCES[name].fieldNames()


def test_client_without_known_type_or_status_is_kept(spark):
    shop = Shop(spark, client=[client(1), client(2, None, 9), client(3, 9, None)])
    assert rows_of(shop.dim_client, "client_id", "type_name", "status_name") == [
        (1, "Standard", "Active"),
        (2, None, None),
        (3, None, None),
    ]


def test_names_are_not_masked_and_contact_data_is(spark):
    row = Shop(spark).dim_client.first()
    assert (row.client_name, row.email, row.phone_number, row.address) == (
        "Client 1",
        "c***@mail.example",
        "(***) ***-0001",
        "12 ***",
    )


def test_fact_drops_orders_without_lines_and_lines_without_orders(spark):
    shop = Shop(
        spark,
        orders=[order(1), order(2)],
        order_product=[line(11, 1), line(12, 1), line(31, 3), line(99, None)],
    )
    assert rows_of(shop.fact, "order_product_id", "order_id") == [(11, 1), (12, 1)]


def test_fact_columns(spark):
    assert Shop(spark).fact.columns == [
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
    ]


def test_order_total_repeats_on_every_line(spark):
    shop = Shop(spark, orders=[order(1)], order_product=[line(11, 1), line(12, 1)])
    assert [r.total_amount for r in shop.fact.collect()] == [Decimal("10.00")] * 2
