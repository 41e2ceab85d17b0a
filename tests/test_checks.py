"""Data-quality checks and audits on edge rows."""

from __future__ import annotations

from fixtures import Shop, client, line, order, product, rows_of

from tallyloom.model import FOREIGN_KEYS, PRIMARY_KEYS
from tallyloom.operators import checks
from tallyloom.operators.counts import row_counts


def faulty(spark):
    return Shop(
        spark,
        client=[client(1), client(1), client(1), client(None), client(None)],
        client_type=[(1, "Standard"), (None, "Nameless")],
        product=[product(1)],
        orders=[order(1), order(2, 99), order(3, None), order(4, 1, 7)],
        order_product=[line(1, 1), line(1, 2, 88), line(2, 3, 88), line(3, 4, None), line(4, 2)],
    )


def test_duplicates_include_null_keys(spark):
    found = checks.duplicate_keys(faulty(spark).client, "client_id")
    assert rows_of(found) == [(None, 2), (1, 3)]


def test_null_counts_of_several_columns(spark):
    counts = checks.null_counts(faulty(spark).client, ["client_id", "email"])
    assert dict(rows_of(counts)) == {"client_id": 2, "email": 0}


def test_orphans_leave_null_to_the_not_null_check(spark):
    shop = faulty(spark)
    found = checks.orphan_keys(shop.fact, shop.models())
    assert sorted(rows_of(found)) == [
        ("client_id", 99, 2),
        ("payment_id", 7, 1),
        ("product_id", 88, 2 * 1),
    ]


def test_report_lists_every_declared_check(spark):
    report = checks.quality_report(Shop(spark).models()).collect()
    assert len(report) == 28
    kinds = [row.check_name for row in report]
    assert [kinds.count(k) for k in ("unique", "not_null", "relationships")] == [11, 14, 3]
    assert all(row.passed and row.failures == 0 for row in report)


def test_report_counts_failures(spark):
    shop = faulty(spark)
    report = {
        (row.model, row.column_name, row.check_name): row.failures
        for row in checks.quality_report(shop.models()).collect()
        if not row.passed
    }
    assert report == {
        ("stg_client", "client_id", "unique"): 2,
        ("stg_client", "client_id", "not_null"): 2,
        ("dim_client", "client_id", "unique"): 2,
        ("dim_client", "client_id", "not_null"): 2,
        ("stg_client_type", "client_type_id", "not_null"): 1,
        ("stg_order_product", "order_product_id", "unique"): 1,
        ("fact_orders", "order_product_id", "unique"): 1,
        ("fact_orders", "client_id", "not_null"): 1,
        ("fact_orders", "product_id", "not_null"): 1,
        ("fact_orders", "client_id", "relationships"): 2,
        ("fact_orders", "product_id", "relationships"): 2,
        ("fact_orders", "payment_id", "relationships"): 1,
    }


def test_single_reports_agree_with_the_whole(spark):
    models = faulty(spark).models()
    whole = {
        (row.model, row.column_name, row.check_name): row.failures
        for row in checks.quality_report(models).collect()
    }
    for row in checks.not_null_report(models).collect():
        assert whole.pop((row.model, row.column_name, "not_null")) == row.null_rows
    for row in checks.relationship_report(models).collect():
        assert whole.pop((row.model, row.column_name, "relationships")) == row.orphan_rows
    duplicates = checks.unique_failures(models).collect()
    for (model, column, kind), failures in whole.items():
        assert kind == "unique"
        assert failures == sum((d.model, d.column_name) == (model, column) for d in duplicates)
    assert len(whole) == len(PRIMARY_KEYS)
    assert len(FOREIGN_KEYS) == 3


def test_row_counts(spark):
    shop = faulty(spark)
    counts = row_counts({"orders": shop.orders, "fact": shop.fact, "none": shop.orders.limit(0)})
    assert dict(rows_of(counts)) == {"orders": 4, "fact": 5, "none": 0}
