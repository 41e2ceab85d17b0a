"""Marts, cubes and extracts on edge rows, in both rollup forms."""

from __future__ import annotations

from collections import defaultdict
from datetime import date
from decimal import Decimal

import pytest
from fixtures import Shop, client, line, order, product, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyloom.operators.cube import sales_cube, sales_cube_plain
from tallyloom.plans import extracts, marts, rollups

D = Decimal


def from_fact(shop):
    return rollups.order_sales(shop.fact)


def from_lines(shop):
    return rollups.order_sales_from_lines(shop.orders, shop.order_product)


def categories_from_fact(shop):
    return rollups.category_sales(shop.fact, shop.dim_product)


def categories_from_lines(shop):
    return rollups.category_sales_from_lines(shop.orders, shop.order_product, shop.dim_product)


both_orders = pytest.mark.parametrize("sales_of", [from_fact, from_lines])
both_categories = pytest.mark.parametrize("sales_of", [categories_from_fact, categories_from_lines])


@both_orders
def test_monthly(spark, sales_of):
    shop = Shop(
        spark,
        orders=[order(1, day="2024-06-01"), order(2, day="2024-06-30"), order(3, day="2024-07-01")],
        order_product=[
            line(1, 1, quantity="45.5", price="45.50"),
            line(2, 1, quantity="1.0", price="0.05"),
            line(3, 2, quantity="2.0", price="10.00"),
            line(4, 3, quantity="0.5", price="0.01"),
        ],
    )
    assert rows_of(marts.mart_monthly_sales(sales_of(shop))) == [
        (date(2024, 6, 1), 2, D("48.5"), D("2090.300"), D("1045.15")),
        (date(2024, 7, 1), 1, D("0.5"), D("0.005"), D("0.01")),
    ]


@both_orders
def test_missing_quantity_or_price_adds_nothing(spark, sales_of):
    shop = Shop(
        spark,
        orders=[order(1)],
        order_product=[line(1, 1, quantity=None), line(2, 1, price=None), line(3, 1)],
    )
    assert rows_of(extracts.kpi_totals(sales_of(shop))) == [(1, 1, D("2.0"), D("10.000"))]


@both_categories
def test_order_in_two_categories_counts_once_in_each(spark, sales_of):
    shop = Shop(
        spark,
        product=[product(1, "Books"), product(2, "Music"), product(3, "Unsold")],
        orders=[order(1)],
        order_product=[line(1, 1, 1), line(2, 1, 2), line(3, 1, 2), line(4, 1, 77)],
    )
    sales = sales_of(shop)
    assert rows_of(marts.mart_sales_by_category(sales), "category", "total_orders") == [
        ("Books", 1),
        ("Music", 1),
    ]
    cube = marts.mart_cube_category_month(sales)
    assert rows_of(cube, "category", "month", "total_orders", "total_units_sold") == [
        ("ALL CATEGORIES", "2024-06-01", 1, D("3.0")),
        ("ALL CATEGORIES", "ALL MONTHS", 1, D("3.0")),
        ("Books", "2024-06-01", 1, D("1.0")),
        ("Books", "ALL MONTHS", 1, D("1.0")),
        ("Music", "2024-06-01", 1, D("2.0")),
        ("Music", "ALL MONTHS", 1, D("2.0")),
    ]


@both_categories
def test_missing_category_shares_the_subtotal_label(spark, sales_of):
    shop = Shop(
        spark,
        product=[product(1, "Books"), product(2, None)],
        orders=[order(1), order(2, day="2024-07-01")],
        order_product=[line(1, 1, 1), line(2, 1, 2), line(3, 2, 1)],
    )
    cube = marts.mart_cube_category_month(sales_of(shop))
    labelled = cube.filter("category = 'ALL CATEGORIES'")
    assert rows_of(labelled, "month", "total_orders", "total_units_sold") == [
        ("2024-06-01", 1, D("1.0")),
        ("2024-06-01", 1, D("2.0")),
        ("2024-07-01", 1, D("1.0")),
        ("ALL MONTHS", 1, D("1.0")),
        ("ALL MONTHS", 2, D("3.0")),
    ]
    assert rows_of(extracts.cells_category_month(cube), "category", "month") == [
        ("Books", "2024-06-01"),
        ("Books", "2024-07-01"),
    ]


@both_orders
def test_missing_status_shares_the_subtotal_label(spark, sales_of):
    shop = Shop(
        spark,
        orders=[order(1, status=None), order(2, status="Shipped"), order(3, payment_id=9)],
        order_product=[line(1, 1), line(2, 2), line(3, 3)],
    )
    cube = marts.mart_cube_payment_status(sales_of(shop), shop.dim_payment)
    assert rows_of(cube, "payment_method", "order_status", "total_orders") == [
        ("ALL METHODS", "ALL STATUSES", 1),
        ("ALL METHODS", "ALL STATUSES", 2),
        ("ALL METHODS", "Shipped", 1),
        ("card", "ALL STATUSES", 1),
        ("card", "ALL STATUSES", 2),
        ("card", "Shipped", 1),
    ]
    assert rows_of(extracts.cells_payment_status(cube), "payment_method", "order_status") == [
        ("card", "Shipped")
    ]


@both_orders
def test_client_types(spark, sales_of):
    shop = Shop(
        spark,
        client=[client(1), client(2), client(3, None), client(4, 2)],
        orders=[order(1, 1), order(2, 1), order(3, 2), order(4, 3), order(5, 99), order(6, None)],
        order_product=[line(n, n) for n in range(1, 7)],
    )
    result = marts.mart_sales_by_client_type(sales_of(shop), shop.dim_client)
    assert rows_of(result) == [
        (None, 1, 1, D("10.000"), D("10.00")),
        ("Standard", 2, 3, D("30.000"), D("15.00")),
    ]


@both_orders
def test_clients(spark, sales_of):
    shop = Shop(
        spark,
        client=[client(1), client(2, 2, 9), client(3)],
        orders=[order(1, 1), order(2, 1, day="2024-08-01"), order(3, 2), order(4, 99)],
        order_product=[line(1, 1), line(2, 1), line(3, 2), line(4, 3), line(5, 4)],
    )
    result = marts.mart_sales_by_client(sales_of(shop), shop.dim_client)
    june, august = date(2024, 6, 15), date(2024, 8, 1)
    assert rows_of(result) == [
        (1, "Client 1", "Standard", "Active", 2, D("3.0"), D("30.000"), june, august),
        (2, "Client 2", "Premium", None, 1, D("1.0"), D("10.000"), june, june),
    ]


@both_orders
def test_repeated_keys_behave_like_the_plain_join(spark, sales_of):
    """Order 1 comes again with other attributes, client 1 twice alike, client 2 twice unlike."""
    shop = Shop(
        spark,
        client=[client(1), client(1), client(2), client(2, client_name="Other")],
        payment_method=[(1, "card"), (1, "card"), (2, "card")],
        orders=[order(1), order(1, 2, 2, "2024-07-01", "Shipped"), order(1), order(2, 2)],
        order_product=[line(1, 1), line(2, 1), line(3, 2)],
    )
    sales = sales_of(shop)
    lines = shop.fact.withColumnsRenamed({"quantity": "units"}).withColumn(
        "revenue", F.col("price_unit") * F.col("units")
    )
    plain_client = (
        lines.join(shop.dim_client, "client_id")
        .groupBy("client_id", "client_name", "type_name", "status_name")
        .agg(
            F.count_distinct("order_id"),
            F.sum("units"),
            F.sum("revenue"),
            F.min("order_date"),
            F.max("order_date"),
        )
    )
    assert rows_of(marts.mart_sales_by_client(sales, shop.dim_client)) == rows_of(plain_client)
    plain_type = (
        lines.join(shop.dim_client, "client_id")
        .groupBy("type_name")
        .agg(F.count_distinct("client_id"), F.count_distinct("order_id"), F.sum("revenue"))
    )
    by_type = marts.mart_sales_by_client_type(sales, shop.dim_client)
    assert rows_of(by_type.drop("revenue_per_client")) == rows_of(plain_type)
    plain_cube = sales_cube_plain(
        lines.join(shop.dim_payment, "payment_id"), "payment_method", "status"
    )
    cube = marts.mart_cube_payment_status(sales, shop.dim_payment)
    labelled = plain_cube.na.fill({"payment_method": "ALL METHODS", "status": "ALL STATUSES"})
    assert rows_of(cube) == rows_of(labelled)
    assert rows_of(extracts.kpi_totals(sales)) == [(2, 2, D("7.0"), D("70.000"))]


def test_empty_fact(spark):
    shop = Shop(spark)
    sales, by_category = from_lines(shop), categories_from_lines(shop)
    assert rows_of(extracts.kpi_totals(sales)) == [(0, 0, None, None)]
    for mart in (
        marts.mart_monthly_sales(sales),
        marts.mart_sales_by_category(by_category),
        marts.mart_sales_by_client(sales, shop.dim_client),
        marts.mart_sales_by_client_type(sales, shop.dim_client),
        marts.mart_cube_category_month(by_category),
        marts.mart_cube_payment_status(sales, shop.dim_payment),
    ):
        assert mart.collect() == []
    cells = extracts.cells_category_month(marts.mart_cube_category_month(by_category))
    assert extracts.sold_months(cells) == []
    assert extracts.heatmap_category_month(cells, []).collect() == []


def test_category_without_units_is_a_division_error(spark):
    shop = Shop(spark, orders=[order(1)], order_product=[line(1, 1, quantity="0.0")])
    with pytest.raises(PySparkException, match="DIVIDE_BY_ZERO"):
        marts.mart_sales_by_category(categories_from_lines(shop)).collect()


def test_average_keeps_its_digits_until_it_is_rounded(spark):
    """0.33499997 must not become 0.335 on the way, as it would with six digits."""
    df = spark.sql("select cast(33499.997 as decimal(38,3)) as total, 100000L as n")
    value = df.select(marts.average_per_count(F.col("total"), F.col("n"))).first()[0]
    assert value == D("0.33")


def test_top_clients_breaks_ties_by_id(spark):
    ids = range(1, 14)
    shop = Shop(
        spark,
        client=[client(n) for n in ids],
        orders=[order(n, n) for n in ids],
        order_product=[line(n, n, price="20.00" if n == 13 else "10.00") for n in ids],
    )
    top = extracts.top_clients(marts.mart_sales_by_client(from_lines(shop), shop.dim_client))
    assert [row.client_id for row in top.collect()] == [13, *range(1, 10)]


def two_categories(spark):
    return Shop(
        spark,
        product=[product(1, "Books"), product(2, "Music")],
        orders=[order(1), order(2, day="2024-08-03")],
        order_product=[line(1, 1, 1), line(2, 2, 1), line(3, 2, 2)],
    )


def test_heatmap_leaves_empty_cells_null(spark):
    shop = two_categories(spark)
    cells = extracts.cells_category_month(
        marts.mart_cube_category_month(categories_from_lines(shop))
    )
    months = extracts.sold_months(cells)
    assert months == ["2024-06-01", "2024-08-01"]
    matrix = extracts.heatmap_category_month(cells, months)
    assert matrix.columns == ["category", *months]
    assert rows_of(matrix) == [
        ("Books", D("10.000"), D("10.000")),
        ("Music", None, D("10.000")),
    ]
    series = extracts.heatmap_series(cells)
    assert rows_of(series, "category", "month_label") == [
        ("Books", "Aug 2024"),
        ("Books", "Jun 2024"),
        ("Music", "Aug 2024"),
    ]


def test_revenue_share(spark):
    mart = marts.mart_sales_by_category(categories_from_lines(two_categories(spark)))
    share = extracts.category_revenue_share(mart)
    assert rows_of(share, "category", "share_pct") == [
        ("Books", D("66.67")),
        ("Music", D("33.33")),
    ]
    nothing = extracts.category_revenue_share(mart.withColumn("total_revenue", F.lit(D("0.000"))))
    assert rows_of(nothing, "share_pct") == [(None,), (None,)]


def test_display_order(spark):
    shop = two_categories(spark)
    by_category = categories_from_lines(shop)
    cube = extracts.in_display_order(
        "mart_cube_category_month", marts.mart_cube_category_month(by_category)
    )
    assert [(r.category, r.month) for r in cube.collect()] == [
        ("Books", "2024-06-01"),
        ("Books", "2024-08-01"),
        ("Books", "ALL MONTHS"),
        ("Music", "2024-08-01"),
        ("Music", "ALL MONTHS"),
        ("ALL CATEGORIES", "2024-06-01"),
        ("ALL CATEGORIES", "2024-08-01"),
        ("ALL CATEGORIES", "ALL MONTHS"),
    ]
    mart = extracts.in_display_order(
        "mart_sales_by_category", marts.mart_sales_by_category(by_category)
    )
    assert [r.category for r in mart.collect()] == ["Books", "Music"]
    clients = marts.mart_sales_by_client(from_lines(shop), shop.dim_client)
    assert extracts.in_display_order("mart_sales_by_client", clients).count() == 1


# The cube against a brute-force count, and against Spark's own cube.

sale_rows = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(1, 5)),
        st.one_of(st.none(), st.sampled_from("ABC")),
        st.one_of(st.none(), st.sampled_from("xyz")),
        st.integers(0, 999),
    ),
    max_size=25,
)


def brute_force_cube(rows):
    groups = defaultdict(list)
    for key, a, b, cents in rows:
        # A subtotal is a group of its own, apart from a NULL in the data.
        for level, group in ((0, (a, b)), (1, (a, None)), (2, (None, b)), (3, (None, None))):
            groups[level, group].append((key, cents))
    return sorted(
        (
            (
                *group,
                len({key for key, _ in members if key is not None}),
                sum(D(cents) / 10 for _, cents in members),
            )
            for (_, group), members in groups.items()
        ),
        key=str,
    )


@given(rows=sale_rows)
@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
def test_cube_equals_brute_force(spark, rows):
    data = [(key, a, b, D(cents) / 10, D(cents)) for key, a, b, cents in rows]
    sales = spark.createDataFrame(
        data, "order_id bigint, a string, b string, units decimal(10,1), revenue decimal(21,3)"
    )
    columns = ["a", "b", "total_orders", "total_units_sold"]
    expected = brute_force_cube(rows)
    for cube in (sales_cube(sales, "a", "b"), sales_cube_plain(sales, "a", "b")):
        found = sorted((tuple(r) for r in cube.select(columns).collect()), key=str)
        assert sorted(found, key=str) == sorted(
            [(a, b, n, D(u).quantize(D("0.1"))) for a, b, n, u in expected], key=str
        )


def test_cube_totals_agree_with_the_overall_totals(spark, sf_dir):
    from tallyloom.catalog import QUERIES

    kpi = QUERIES["kpi_totals"](spark, sf_dir).first()
    for name in ("mart_cube_category_month", "mart_cube_payment_status"):
        rows = [tuple(r) for r in QUERIES[name](spark, sf_dir).collect()]
        grand = [r for r in rows if r[0].startswith("ALL ") and r[1].startswith("ALL ")]
        assert [r[2:] for r in grand] == [(kpi.orders, kpi.units, kpi.revenue)]
        for row in rows:
            if row[0].startswith("ALL ") or not row[1].startswith("ALL "):
                continue
            cells = [r for r in rows if r[0] == row[0] and not r[1].startswith("ALL ")]
            assert sum(r[3] for r in cells) == row[3]
            assert sum(r[4] for r in cells) == row[4]
            assert max(r[2] for r in cells) <= row[2] <= sum(r[2] for r in cells)
