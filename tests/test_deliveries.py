"""Stamps in file names, what became of every file, freshness, and sums across grains."""

from __future__ import annotations

import shutil
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from fixtures import line, order, rows_of, table
from pyspark.sql import functions as F

from tallyloom import catalog
from tallyloom.operators.checks import order_total_mismatches
from tallyloom.sources.csv_files import FileDrop
from tallyloom.sources.deliveries import delivered_at, delivered_files, delivery_status, freshness
from tallyloom.streaming import landing


@pytest.mark.parametrize(
    ("path", "expected"),
    [
        ("file:/in/client/client__2025_22_03_13_50.csv", datetime(2025, 3, 22, 13, 50)),
        ("s3a://b/x__2024_01_01_00_00/client__2025_05_12_00_59-3.csv.gz", datetime(2025, 12, 5, 0, 59)),
        ("client__2025_29_02_13_50.csv", None),
        ("client__2025_13_31_13_50.csv", None),
        ("client__2025_22_03_24_00.csv", None),
        ("client__2025_22_03_13_501.csv", None),
        ("client__1.csv", None),
        (None, None),
        # A time that clocks in Berlin skip.
        ("client__2025_30_03_02_30.csv", datetime(2025, 3, 30, 2, 30)),
    ],
)
def test_the_day_stands_before_the_month(spark, path, expected):
    row = spark.createDataFrame([(path,)], "path string").select(delivered_at(F.col("path")).alias("at")).first()
    assert row["at"] == expected


def put(folder: Path, name: str, *lines: str):
    file = folder / name.split("__")[0] / name
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text("\n".join(["h", *lines]) + "\n")


def test_empty_loaded_and_waiting_files_are_told_apart(spark, tmp_path):
    drop = FileDrop(str(tmp_path / "in"))
    put(tmp_path / "in", "client_type__2025_22_03_00_00.csv", "1,Standard", "2,Premium,surplus")
    put(tmp_path / "in", "client_type__2025_23_03_00_00.csv")
    put(tmp_path / "in", "payment_method__2025_23_03_00_00.csv")
    landed = str(tmp_path / "landed")
    landing.land(spark, drop, landed, str(tmp_path / "cp"))
    put(tmp_path / "in", "client_type__later.csv", "3,VIP")
    status = delivery_status(spark, drop, landing.landing_status(spark, landed))
    assert rows_of(status, "table_name", "delivered_at", "row_count", "landed_rows", "rejected_rows", "state") == [
        ("client_type", None, 1, 0, 0, "waiting"),
        ("client_type", datetime(2025, 3, 22), 2, 2, 1, "loaded"),
        ("client_type", datetime(2025, 3, 23), 0, 0, 0, "empty"),
        ("payment_method", datetime(2025, 3, 23), 0, 0, 0, "empty"),
    ]


def test_freshness_of_every_table(spark, tmp_path):
    drop = FileDrop(str(tmp_path))
    put(tmp_path, "client__2025_22_03_13_50.csv")
    put(tmp_path, "client__2025_01_05_13_50.csv")  # after the moment
    put(tmp_path, "client__unnamed.csv")
    put(tmp_path, "orders__2025_20_03_13_50.csv", "1")
    put(tmp_path, "product__x.csv", "1")
    now, limit = datetime(2025, 3, 22, 14, 50), timedelta(hours=1)
    report = freshness(delivered_files(spark, drop), now, limit, ("client", "orders", "product", "client_type"))
    assert rows_of(report) == [
        ("client", datetime(2025, 3, 22, 13, 50), 1, 1, 60, True),
        ("client_type", None, 0, 0, None, False),
        ("orders", datetime(2025, 3, 20, 13, 50), 1, 0, 2940, False),
        ("product", None, 0, 1, None, False),
    ]
    assert freshness(delivered_files(spark, FileDrop(str(tmp_path / "none"))), now, limit).filter("fresh").isEmpty()


def test_totals_that_differ_from_their_lines(spark):
    orders = [order(1), order(2), order(3), (4, 1, 1, None, "x", None), (5, 1, 1, None, "x", None), order(6), order(6), (None, *order(7)[1:])]
    lines = [line(1, 1), line(2, 2, price="4.00"), line(3, 2, price="6.01"), line(4, 4), line(5, 6, price=None), line(6, 8), line(7, None)]
    found = order_total_mismatches(table(spark, "orders", orders), table(spark, "order_product", lines))
    ten = Decimal("10.00")
    assert rows_of(found) == [
        (2, ten, Decimal("10.010"), Decimal("-0.010"), 2),
        (3, ten, None, None, 0),
        (4, None, Decimal("10.000"), None, 1),
        (6, ten, None, None, 1),
        (6, ten, None, None, 1),
        (8, None, Decimal("10.000"), None, 1),
    ]


def test_totals_meet_their_lines_reduced(spark, sf_dir):
    plan = catalog.QUERIES["order_total_mismatches"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join FullOuter") < plan.index("Aggregate")


@pytest.mark.parametrize("name", ["cells_category_month", "heatmap_series", "heatmap_category_month"])
def test_no_query_answers_from_rows_that_have_changed(spark, sf_dir, tmp_path, name):
    folder = tmp_path / "tables"
    folder.mkdir()
    for file in Path(sf_dir).glob("*.parquet"):
        shutil.copyfile(file, folder / file.name)
    catalog.QUERIES["heatmap_category_month"](spark, str(folder)).collect()
    before = catalog.QUERIES[name](spark, str(folder)).collect()
    fewer = tmp_path / "fewer"
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").filter("l_linenumber = 1").coalesce(1).write.parquet(str(fewer))
    shutil.copyfile(next(fewer.glob("*.parquet")), folder / "lineitem.parquet")
    result = catalog.QUERIES[name](spark, str(folder))
    assert "InMemoryTableScan" not in result._jdf.queryExecution().executedPlan().toString()
    assert result.collect() != before


def test_the_share_reads_the_mart_once(spark, sf_dir):
    plan = catalog.QUERIES["category_revenue_share"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lineitem") + plan.count("l_orderkey") > 0
    assert sum("Relation" in row and "l_orderkey" in row for row in plan.splitlines()) == 1


def test_a_build_drops_no_schema_it_has_not_made(spark, sf_dir):
    spark.sql("CREATE SCHEMA rebuilt_oltp")
    try:
        spark.range(1).write.saveAsTable("rebuilt_oltp.mine")
        first = catalog.QUERIES["warehouse_build"](spark, sf_dir)
        second = catalog.QUERIES["warehouse_build"](spark, sf_dir)
        assert rows_of(first) == rows_of(second)
        assert spark.table("rebuilt_oltp.mine").count() == 1
    finally:
        spark.sql("DROP SCHEMA rebuilt_oltp CASCADE")
