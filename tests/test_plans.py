"""Physical plans: what is shuffled, what is read, and how hot keys are treated."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tallyloom import session
from tallyloom.catalog import QUERIES
from tallyloom.operators.cube import sales_cube, sales_cube_plain
from tallyloom.plans import marts, rollups, star, warehouse
from tallyloom.session import spread, tune



@contextmanager
def settings(spark, **values):
    """Session settings for one test, written with ``__`` for the dots."""
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shuffle_joins(spark):
    """As if every side were too large to broadcast."""
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    """The plan as it was at the end of a run."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


def shuffles(plan):
    """Clustering columns of every hash exchange, from the root down."""
    found = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    return [re.sub(r"#\d+L?", "", columns) for columns in found]


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("ingest_csv")))
def test_no_query_leaves_the_jvm_or_joins_without_a_key(spark, sf_dir, name):
    plan = planned(QUERIES[name](spark, sf_dir))
    assert not re.search(r"Python|Arrow|MapInPandas|Cartesian|NestedLoop", plan)


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("mart_monthly_sales", {"l_orderkey", "l_quantity", "l_extendedprice"}),
        ("mart_sales_by_category", {"l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"}),
        ("row_counts_star", {"l_orderkey"}),
    ],
)
def test_only_needed_line_columns_are_read(spark, sf_dir, name, columns):
    plan = planned(QUERIES[name](spark, sf_dir))
    scans = [s for s in re.findall(r"FileScan parquet \[(.*?)\]", plan) if "l_orderkey" in s]
    assert scans
    for scan in scans:
        assert set(re.sub(r"#\d+L?", "", scan).split(",")) == columns


def test_lookups_are_broadcast_by_size_only(spark, sf_dir):
    assert planned(QUERIES["dim_client"](spark, sf_dir)).count("BroadcastHashJoin") == 2
    with shuffle_joins(spark):
        assert "BroadcastHashJoin" not in planned(QUERIES["dim_client"](spark, sf_dir))


def test_lines_are_reduced_before_they_meet_their_orders(spark, sf_dir):
    with shuffle_joins(spark):
        plan = planned(QUERIES["mart_monthly_sales"](spark, sf_dir))
    # One shuffle of reduced lines and one of orders; the distinct count needs none.
    assert shuffles(plan)[1:] == ["order_id", "order_id"]
    below_lines_shuffle = plan.split("hashpartitioning(order_id")[1]
    assert "partial_sum" in below_lines_shuffle


def test_clients_are_reduced_before_the_dimension_join(spark, sf_dir):
    with shuffle_joins(spark):
        plan = executed(QUERIES["mart_sales_by_client"](spark, sf_dir))
    before_join = plan.split("SortMergeJoin [client_id")[0]
    assert "hashpartitioning" not in before_join
    assert "count(distinct order_id" in plan.split("SortMergeJoin [client_id")[1]


def test_totals_shuffle_one_row_per_client(spark, sf_dir):
    with shuffle_joins(spark):
        plan = planned(QUERIES["kpi_totals"](spark, sf_dir))
    assert "Expand" not in plan
    assert shuffles(plan) == ["client_id", "order_id", "order_id"]


def test_sales_by_client_type_expand_no_orders(spark, sf_dir):
    with shuffle_joins(spark):
        plan = planned(QUERIES["mart_sales_by_client_type"](spark, sf_dir))
    assert "Expand" not in plan


def test_cube_expands_cells_not_sales(spark, sf_dir):
    with shuffle_joins(spark):
        plan = planned(QUERIES["mart_cube_category_month"](spark, sf_dir))
    assert plan.count("Expand") == 1
    # From the cube down to the order join nothing but cells is shuffled.
    assert shuffles(plan) == [
        "category, month, spark_grouping_id",
        "category, month",
        "order_id",
        "order_id, category",
        "product_id",
        "product_id",
        "order_id",
    ]


def test_share_reads_sales_once(spark, sf_dir):
    plan = executed(QUERIES["category_revenue_share"](spark, sf_dir))
    final = plan.split("== Initial Plan ==")[0]
    # The mart stands in the plan once, so nothing is left to be reused.
    assert final.count("l_extendedprice:double") == 1


def test_top_clients_keeps_only_the_top(spark, sf_dir):
    assert "TakeOrderedAndProject" in planned(QUERIES["top_clients"](spark, sf_dir))


def test_marts_over_stored_rollups_do_not_shuffle_orders(spark, skewed):
    orders, lines, products = skewed
    spark.sql("CREATE SCHEMA IF NOT EXISTS work")
    try:
        fact = star.fact_orders(orders, lines)
        sales = warehouse._store_rollup("order_sales", rollups.order_sales(fact))
        by_category = warehouse._store_rollup(
            "category_sales", rollups.category_sales(fact, products)
        )
        payment = spark.range(4).selectExpr("id AS payment_id", "concat('P', id) AS payment_method")
        for mart in (
            marts.mart_monthly_sales(sales),
            marts.mart_sales_by_category(by_category),
            marts.mart_cube_category_month(by_category),
            marts.mart_cube_payment_status(sales, payment),
        ):
            assert not any("order_id" in columns for columns in shuffles(planned(mart)))
        assert sales.agg(F.sum("units")).first() == lines.agg(F.sum("quantity")).first()
    finally:
        spark.sql("DROP SCHEMA work CASCADE")


# A third of all lines belongs to one order, and a third of all orders to one client.

LINES, ORDERS = 60_000, 6_000


@pytest.fixture(scope="module")
def skewed(spark):
    hot = F.col("id") % 3 == 0
    orders = spark.range(0, ORDERS, 1, 8).select(
        F.col("id").alias("order_id"),
        F.when(hot, 0).otherwise(F.col("id") % 500).alias("client_id"),
        (F.col("id") % 4).alias("payment_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias(
            "order_date"
        ),
        F.when(F.col("id") % 2 == 0, "Shipped").otherwise("Pending").alias("status"),
        F.lit(1).cast("decimal(10,2)").alias("total_amount"),
    )
    lines = spark.range(0, LINES, 1, 16).select(
        F.col("id").alias("order_product_id"),
        F.when(hot, 0).otherwise(F.col("id") % ORDERS).alias("order_id"),
        F.when(F.col("id") % 3 == 1, 7).otherwise(F.col("id") % 50).alias("product_id"),
        (F.col("id") % 9 + 1).cast("decimal(10,1)").alias("quantity"),
        ((F.col("id") % 100) / 4).cast("decimal(10,2)").alias("price_unit"),
    )
    products = spark.range(50).select(
        F.col("id").alias("product_id"),
        F.concat(F.lit("C"), F.col("id") % 5).alias("category"),
    )
    return orders, lines, products


def split_small_skew(spark):
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )


def test_hot_order_is_split_in_the_fact_join(spark, skewed):
    orders, lines, _ = skewed
    with split_small_skew(spark):
        fact = star.fact_orders(orders, lines)
        assert "skew=true" in executed(fact)
        # Also when the next step would rather keep the join's partitioning.
        per_order = fact.groupBy("order_id").agg(F.max("order_product_id"), F.max("price_unit"))
        assert "skew=true" in executed(per_order)
        assert per_order.count() == lines.select("order_id").distinct().count()
        assert fact.count() == LINES


def test_hot_order_never_reaches_the_rollup_join(spark, skewed):
    orders, lines, _ = skewed
    with split_small_skew(spark):
        sales = rollups.order_sales_from_lines(orders, lines)
        plan = executed(sales)
        assert "skew=true" not in plan
        assert sales.count() == sales.select("order_id").distinct().count()
        assert sorted(sales.collect()) == sorted(
            rollups.order_sales(star.fact_orders(orders, lines)).select(*sales.columns).collect()
        )


def test_hot_product_is_split(spark, skewed):
    orders, lines, products = skewed
    with split_small_skew(spark):
        sales = rollups.category_sales_from_lines(orders, lines, products)
        assert "skew=true" in executed(sales)


def test_hot_client_is_split_or_reduced(spark, skewed):
    orders, lines, _ = skewed
    clients = spark.range(500).select(
        F.col("id").alias("client_id"),
        F.concat(F.lit("Client "), "id").alias("client_name"),
        F.concat(F.lit("T"), F.col("id") % 3).alias("type_name"),
        F.lit("Active").alias("status_name"),
    )
    with split_small_skew(spark):
        sales = rollups.order_sales_from_lines(orders, lines)
        by_client = marts.mart_sales_by_client(sales, clients)
        assert "skew=true" not in executed(by_client)
        by_type = marts.mart_sales_by_client_type(sales, clients)
        plan = executed(by_type)
        # One row per client reaches the join: nothing is expanded, nothing left to split.
        assert "Expand" not in plan.split("count(distinct order_id")[0] and "skew=true" not in plan
        counted = by_type.agg(F.sum("total_clients"), F.sum("total_orders")).first()
        sold = sales.agg(F.count_distinct("client_id"), F.count_distinct("order_id")).first()
        assert tuple(counted) == tuple(sold)


def test_cube_of_skewed_sales_equals_the_plain_cube(spark, skewed):
    orders, lines, products = skewed
    with split_small_skew(spark):
        sales = rollups.category_sales_from_lines(orders, lines, products)
        sales = sales.withColumn("month", F.trunc("order_date", "MM"))
        ours = sales_cube(sales, "category", "month").collect()
        plain = sales_cube_plain(sales, "category", "month").collect()
    assert sorted(ours, key=str) == sorted(plain, key=str)


def test_tasks_get_small_shares_of_files_and_shuffles(spark):
    split = "spark.sql.files.maxPartitionBytes"
    merged = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    sizes = settings(
        spark,
        spark__sql__files__maxPartitionBytes="128MB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4194304",
    )
    with sizes:
        tune(spark)
        # What is large is lowered, what is smaller stays.
        assert (spark.conf.get(split), spark.conf.get(merged)) == (str(16 << 20), "4194304")
    with settings(spark, spark__sql__files__maxPartitionBytes="1m"):
        tune(spark)
        assert spark.conf.get(split) == "1m"


def test_more_rows_make_more_tasks_not_larger_ones(spark, tmp_path):
    at = str(tmp_path / "rows")
    parts = settings(
        spark,
        spark__sql__files__maxPartitionBytes="128MB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64MB",
        spark__sql__shuffle__partitions="16",
    )
    with parts:
        tune(spark)
        # Numbers that do not compress: about 48 MB in one file, in groups of 2 MB.
        rows = spark.range(3_000_000, numPartitions=1).select(
            F.xxhash64("id").alias("key"), F.xxhash64("id", F.lit(1)).alias("value")
        )
        rows.write.option("parquet.block.size", 2 << 20).parquet(at)
        stored = spark.read.parquet(at)
        assert stored.rdd.getNumPartitions() >= 3
        grouped = stored.groupBy("key").agg(F.max("value").alias("value"))
        assert grouped.rdd.getNumPartitions() >= 5


PARTS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def unspread(spark):
    """As if no query had asked for more parts of a shuffle yet."""
    return settings(
        spark,
        spark__sql__shuffle__partitions="4",
        spark__sql__adaptive__coalescePartitions__initialPartitionNum="4",
    )


def test_shuffles_get_more_parts_for_larger_files(spark):
    with unspread(spark):
        spread(spark, 1 << 20)
        assert spark.conf.get(PARTS) == "4"
        spread(spark, (100 << 20) + 1)
        assert spark.conf.get(PARTS) == "51"
        # A smaller query leaves the session as it is.
        spread(spark, 1 << 20)
        assert spark.conf.get(PARTS) == "51"
        # The sizes of so many parts are still told one by one.
        spread(spark, 1 << 50)
        assert spark.conf.get(PARTS) == "2000"
        # A session with more parts keeps them.
        with settings(spark, spark__sql__shuffle__partitions="3000"):
            spread(spark, 1 << 20)
            assert spark.conf.get(PARTS) == "3000"
            spark.conf.set(PARTS, "2000")


@pytest.mark.parametrize(
    "name",
    [
        "mart_cube_category_month",
        "heatmap_category_month",
        "mart_sales_by_category",
        "dq_unique",
    ],
)
def test_more_rows_make_more_parts_of_a_shuffle(spark, sf_dir, monkeypatch, name):
    monkeypatch.setattr(session, "FILE_BYTES_A_PART", 32 << 10)
    with unspread(spark), shuffle_joins(spark):
        plan = planned(QUERIES[name](spark, sf_dir))
    parts = {int(n) for n in re.findall(r"Exchange hashpartitioning\(.*?, (\d+)\)", plan)}
    assert len(parts) == 1 and parts.pop() > 20
