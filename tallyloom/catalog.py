"""Every query by name, over a folder of benchmark tables.

A query derives the source tables it needs, stages them and applies the same functions
the warehouse build uses. Marts go from lines to rollup directly, so that lines are
reduced before they meet their orders.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.measures import REVENUE, UNITS, line_revenue, month_of
from tallyloom.model import SOURCES, Schemas
from tallyloom.operators import checks, sketches
from tallyloom.operators.counts import row_counts
from tallyloom.plans import extracts, history, incremental, marts, rollups, staging, star, warehouse
from tallyloom.plans.current import build_current
from tallyloom.session import kept, scratch_folder, spread, tune
from tallyloom.sources import benchmark_tables
from tallyloom.sources.csv_files import REJECTED, FileDrop, accepted, read_delivered, rows_by_file
from tallyloom.sources.deliveries import delivered_at, delivered_files, freshness
from tallyloom.streaming import landing, totals

Query = Callable[[SparkSession, str], DataFrame]


def _sources(
    spark: SparkSession, folder: str, tables: Sequence[str] = tuple(SOURCES)
) -> dict[str, DataFrame]:
    sources = benchmark_tables.load(tune(spark), folder, tables)
    spread(spark, benchmark_tables.file_bytes(spark, folder, tables))
    return sources


def _staged(spark: SparkSession, folder: str, *tables: str) -> list[DataFrame]:
    sources = _sources(spark, folder, tables)
    return [staging.stage(table, sources[table]) for table in tables]


def _staging_query(table: str) -> Query:
    return lambda spark, folder: _staged(spark, folder, table)[0]


# Star schema


def dim_client(spark: SparkSession, folder: str) -> DataFrame:
    return star.dim_client(*_staged(spark, folder, "client", "client_type", "client_status"))


def dim_product(spark: SparkSession, folder: str) -> DataFrame:
    return star.dim_product(*_staged(spark, folder, "product"))


def dim_payment(spark: SparkSession, folder: str) -> DataFrame:
    return star.dim_payment(*_staged(spark, folder, "payment_method"))


def fact_orders(spark: SparkSession, folder: str) -> DataFrame:
    return star.fact_orders(*_staged(spark, folder, "orders", "order_product"))


# Marts


def _order_sales(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.order_sales_from_lines(*_staged(spark, folder, "orders", "order_product"))


def _category_sales(spark: SparkSession, folder: str) -> DataFrame:
    orders, lines = _staged(spark, folder, "orders", "order_product")
    return rollups.category_sales_from_lines(orders, lines, dim_product(spark, folder))


def _monthly(spark: SparkSession, folder: str) -> DataFrame:
    return marts.mart_monthly_sales(_order_sales(spark, folder))


def _by_category(spark: SparkSession, folder: str) -> DataFrame:
    return marts.mart_sales_by_category(_category_sales(spark, folder))


def _by_client_type(spark: SparkSession, folder: str) -> DataFrame:
    return marts.mart_sales_by_client_type(_order_sales(spark, folder), dim_client(spark, folder))


def _by_client(spark: SparkSession, folder: str) -> DataFrame:
    return marts.mart_sales_by_client(_order_sales(spark, folder), dim_client(spark, folder))


def _cube_category_month(spark: SparkSession, folder: str) -> DataFrame:
    return marts.mart_cube_category_month(_category_sales(spark, folder))


def _cube_payment_status(spark: SparkSession, folder: str) -> DataFrame:
    return marts.mart_cube_payment_status(_order_sales(spark, folder), dim_payment(spark, folder))


def _displayed(mart: str, query: Query) -> Query:
    return lambda spark, folder: extracts.in_display_order(mart, query(spark, folder))


# Quality and audits


def _models(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    staged = dict(zip(staging.STAGING, _staged(spark, folder, *SOURCES), strict=True))
    return staged | {
        "dim_client": star.dim_client(
            staged["stg_client"], staged["stg_client_type"], staged["stg_client_status"]
        ),
        "dim_product": star.dim_product(staged["stg_product"]),
        "dim_payment": star.dim_payment(staged["stg_payment_method"]),
        "fact_orders": star.fact_orders(staged["stg_orders"], staged["stg_order_product"]),
    }


def dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    return checks.unique_failures(_models(spark, folder))


def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return checks.not_null_report(_models(spark, folder))


def dq_relationships(spark: SparkSession, folder: str) -> DataFrame:
    return checks.relationship_report(_models(spark, folder))


def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    return checks.quality_report(_models(spark, folder))


def row_counts_raw(spark: SparkSession, folder: str) -> DataFrame:
    return row_counts(_sources(spark, folder))


def row_counts_star(spark: SparkSession, folder: str) -> DataFrame:
    models = _models(spark, folder)
    names = ("dim_client", "dim_product", "dim_payment", "fact_orders")
    return row_counts({name: models[name] for name in names})


# Extracts


def kpi_totals(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.kpi_totals(_order_sales(spark, folder))


def kpi_cards(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.kpi_cards(kpi_totals(spark, folder))


def monthly_sales_series(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.monthly_sales_series(_monthly(spark, folder))


def category_revenue_share(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.category_revenue_share(_by_category(spark, folder))


def client_type_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.client_type_revenue(_by_client_type(spark, folder))


def cells_category_month(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.cells_category_month(_cube_category_month(spark, folder))


def cells_payment_status(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.cells_payment_status(_cube_payment_status(spark, folder))


def heatmap_series(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.heatmap_series(cells_category_month(spark, folder))


def heatmap_category_month(spark: SparkSession, folder: str) -> DataFrame:
    # The columns depend on the months in the cells. The cells are few but costly, so they
    # are stored between the two looks at them.
    cells = kept(cells_category_month(spark, folder), "cells")
    return extracts.heatmap_category_month(cells, extracts.sold_months(cells))


def top_clients(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.top_clients(_by_client(spark, folder))


# History


def client_history(spark: SparkSession, folder: str) -> DataFrame:
    return history.client_history(benchmark_tables.client_deliveries(tune(spark), folder))


AS_OF_DAY = date(1999, 1, 1)


def clients_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Clients as they were on a day between two deliveries."""
    return history.clients_as_of(client_history(spark, folder), AS_OF_DAY)


def orders_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Every order with the type and status its client had on the day of the order."""
    (orders,) = _staged(spark, folder, "orders")
    known = history.sales_as_of(orders, client_history(spark, folder))
    return known.select("order_id", "client_id", "order_date", "type_id", "status_id", "valid_from")


def sales_by_type_then(spark: SparkSession, folder: str) -> DataFrame:
    (types,) = _staged(spark, folder, "client_type")
    return history.sales_by_type_then(
        _order_sales(spark, folder), client_history(spark, folder), types
    )


def order_total_mismatches(spark: SparkSession, folder: str) -> DataFrame:
    return checks.order_total_mismatches(*_staged(spark, folder, "orders", "order_product"))


# Ingest: the test tables are written as CSV by Spark, then loaded back with types. Spark
# chooses the names of the files it writes, so these queries set their own name pattern.

SPARK_PART_FILES = "part-*"


def _deliver(rows: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    rows.write.mode(mode).option("header", True).option("nullValue", "NULL").csv(folder)


def _halves(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows in two parts by their key; a NULL key belongs to the second."""
    key = F.col(rows.columns[0])
    first = F.coalesce(F.pmod(key, F.lit(2)) == 0, F.lit(False))
    return rows.filter(first), rows.filter(~first)


def _ingest_batch(table: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        drop = FileDrop(scratch_folder(spark, "delivered"), pattern=SPARK_PART_FILES)
        (rows,) = _staged(spark, folder, table)
        _deliver(rows, drop.folder(table))
        return accepted(read_delivered(spark, drop, table), table)

    query.__doc__ = f"Table {table} by way of CSV files, read as one batch."
    return query


def _ingest_stream(table: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        base = scratch_folder(spark, "landing")
        drop = FileDrop(f"{base}/delivered", pattern=SPARK_PART_FILES)
        (rows,) = _staged(spark, folder, table)
        for delivery in _halves(rows):
            _deliver(delivery, drop.folder(table), mode="append")
            landing.land(spark, drop, f"{base}/landed", f"{base}/checkpoints", [table])
        return landing.landed_rows(spark, f"{base}/landed", table)

    query.__doc__ = f"Table {table} by way of CSV files in two deliveries, each loaded on arrival."
    return query


DELIVERY_STAMPS = ("2025_22_03_14_30", "2025_22_04_07_20", "2025_23_04_07_20")


def _deliver_named(rows: DataFrame, drop: FileDrop, table: str, stamp: str) -> None:
    """Files with the names deliveries have: Spark writes them, then they are renamed.

    As many names pass through the driver as the rows have partitions.
    """
    spark = rows.sparkSession
    written = scratch_folder(spark, "written")
    _deliver(rows, written)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(written), hadoop.Path(drop.folder(table))
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(target)
    parts = [f.getPath() for f in files.listStatus(source) if f.getPath().getName().startswith("part-")]
    for n, part in enumerate(parts):
        suffix = f"-{n}" if n else ""
        if not files.rename(part, hadoop.Path(target, f"{table}__{stamp}{suffix}.csv")):
            raise OSError(f"{part} was not renamed")


def ingest_named_files(spark: SparkSession, folder: str) -> DataFrame:
    """Products and order lines in one flat folder, in two deliveries named as shops name them:
    the key of every row and when it was delivered, which the name of its file tells."""
    base = scratch_folder(spark, "named")
    drop = FileDrop(f"{base}/delivered", by_table=False)
    tables = ("product", "order_product")
    for table, rows in zip(tables, _staged(spark, folder, *tables), strict=True):
        for stamp, delivery in zip(DELIVERY_STAMPS, _halves(rows), strict=False):
            _deliver_named(delivery, drop, table, stamp)
    landing.land(spark, drop, f"{base}/landed", f"{base}/checkpoints", tables)
    return reduce(
        DataFrame.unionByName,
        [
            landing.landed(spark, f"{base}/landed", table)
            .filter(F.col(REJECTED).isNull())
            .select(
                F.lit(table).alias("table_name"),
                F.col(SOURCES[table].fieldNames()[0]).alias("row_id"),
                delivered_at(F.col("source_file")).alias("delivered_at"),
            )
            for table in tables
        ],
    )


def ingest_freshness(spark: SparkSession, folder: str) -> DataFrame:
    """Two deliveries of lookups and clients: the newest of each table against a limit of a month."""
    base = scratch_folder(spark, "fresh")
    drop = FileDrop(f"{base}/delivered")
    sent = {"client": DELIVERY_STAMPS[:2], "client_type": DELIVERY_STAMPS[:1], "payment_method": DELIVERY_STAMPS[1:2]}
    for table, stamps in sent.items():
        (rows,) = _staged(spark, folder, table)
        for stamp, delivery in zip(stamps, _halves(rows), strict=False):
            _deliver_named(delivery.coalesce(1), drop, table, stamp)
    files = delivered_files(spark, drop)
    return freshness(files, datetime(2025, 4, 23, 7, 20), timedelta(days=30))


def warehouse_resent(spark: SparkSession, folder: str) -> DataFrame:
    """The monthly mart of a shop that sends rows again: a third of its orders first with another
    status and a day too early, then right; all lines twice. What was delivered last counts."""
    base = scratch_folder(spark, "resent")
    drop = FileDrop(f"{base}/delivered")
    schemas = _new_schemas(spark)
    current = Schemas.prefixed(f"current_{base.rsplit('-', 1)[-1]}")
    tables = dict(zip(SOURCES, _staged(spark, folder, *SOURCES), strict=True))
    again = F.col("order_id") % 3 == 0
    wrong = {
        "status": F.when(again, "?").otherwise(F.col("status")),
        "order_date": F.when(again, F.date_sub("order_date", 1)).otherwise(F.col("order_date")),
    }
    for table, rows in tables.items():
        first = rows.withColumns(wrong) if table == "orders" else rows
        _deliver_named(first, drop, table, DELIVERY_STAMPS[0])
    _deliver_named(tables["orders"].filter(again), drop, "orders", DELIVERY_STAMPS[1])
    _deliver_named(tables["order_product"], drop, "order_product", DELIVERY_STAMPS[2])
    landing.create_raw_tables(spark, f"{base}/landed", schemas)
    landing.land(spark, drop, f"{base}/landed", f"{base}/checkpoints", schemas=schemas)
    build_current(spark, schemas, current, ("orders", "order_product"))
    sales = rollups.order_sales_from_lines(
        spark.table(f"{current.raw}.orders"), spark.table(f"{current.raw}.order_product")
    )
    return marts.mart_monthly_sales(sales)


def warehouse_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Sales by category and month, built in three steps: most orders; then those held back from a
    quarter; then orders that had been dated a month too late. Only touched months are computed."""
    schemas = _new_schemas(spark)
    orders, lines, product = _staged(spark, folder, "orders", "order_product", "product")
    held = F.col("order_date").between(date(1998, 3, 1), date(1998, 5, 31)) & (F.col("order_id") % 2 == 0)
    late = F.col("order_date").between(date(2000, 1, 1), date(2000, 1, 31)) & (F.col("order_id") % 3 == 0)
    dated = orders.withColumn("order_date", F.when(late, F.add_months("order_date", 1)).otherwise(F.col("order_date")))
    steps = [
        (dated.filter(~held), dated.filter(~held)),
        (dated.filter(held), dated),
        (orders.filter(late), orders),
    ]
    for changed, now in steps:
        incremental.refresh(changed, now, lines, product, schemas)
    return incremental.stored(spark, incremental.BY_CATEGORY, schemas)


def ingest_distinct_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in two deliveries, the first of which is sent again under another name: the rows
    that landed, and how often each did."""
    base = scratch_folder(spark, "distinct")
    drop = FileDrop(f"{base}/delivered")
    (orders,) = _staged(spark, folder, "orders")
    first, second = _halves(orders)
    for stamp, delivery in zip(DELIVERY_STAMPS, (first, second, first), strict=True):
        _deliver_named(delivery, drop, "orders", stamp)
        landing.land(spark, drop, f"{base}/landed", f"{base}/checkpoints", ["orders"], distinct_within="1 day")
    return landing.landed_rows(spark, f"{base}/landed", "orders").groupBy(*orders.columns).agg(F.count("*").alias("times"))


def quarterly_clients(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct clients of every quarter, from monthly sketches, beside the exact count."""
    sales = _order_sales(spark, folder).withColumn("month", month_of(F.col("order_date")))
    quarter = F.trunc("month", "quarter").alias("quarter")
    monthly = sketches.distinct_sketches(sales, ["month"], "client_id")
    estimated = sketches.merged_sketches(monthly, [quarter]).withColumn("estimate", sketches.estimate(F.col("sketch")))
    exact = sales.groupBy(quarter).agg(F.count_distinct("client_id").alias("clients"))
    near = sketches.within_bound(F.col("estimate"), F.col("clients")).alias("estimate_within_bound")
    return exact.join(estimated, "quarter").select("quarter", "clients", near)


SALES_UNTIL = ("1997-01-01", "1999-01-01")


def ingest_stream_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly totals of sales that arrive in three deliveries, by date, but every seventh order one
    delivery late: what was still counted, and what came too late, of every month."""
    base = scratch_folder(spark, "totals")
    sales = _order_sales(spark, folder).select("order_id", "order_date", "units", "revenue")
    due = F.when(F.col("order_date") < SALES_UNTIL[0], 0).when(F.col("order_date") < SALES_UNTIL[1], 1).otherwise(2)
    behind = F.when(F.col("order_id") % 7 == 0, 1).otherwise(0)
    # Stored by delivery once; each delivery is then read from its own folder.
    sales.withColumn("delivery", F.least(due + behind, F.lit(2))).write.partitionBy("delivery").parquet(f"{base}/due")
    for n in range(len(SALES_UNTIL) + 1):
        one = spark.read.schema(totals.SALES).parquet(f"{base}/due/delivery={n}")
        one.write.mode("append").parquet(f"{base}/sales")
        totals.start_totals(spark, f"{base}/sales", f"{base}/totals", f"{base}/checkpoint").awaitTermination()
    counted = totals.monthly_totals(spark, f"{base}/totals")
    late = totals.late_sales(spark, f"{base}/totals").groupBy(month_of(F.col("order_date")).alias("month"))
    late = late.agg(F.count("*").alias("late_orders"), F.sum("revenue").cast(REVENUE).alias("late_revenue"))
    return counted.join(late, "month", "full").select(
        "month",
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        "total_units_sold",
        "total_revenue",
        F.coalesce("late_orders", F.lit(0)).alias("late_orders"),
        "late_revenue",
    )


DELIVERIES = ("first", "second")


def ingest_file_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Every table delivered in two folders: good and bad rows by table and delivery, told by
    the path of the file a row came from."""
    base = scratch_folder(spark, "listed")
    drop = FileDrop(base, pattern=SPARK_PART_FILES)
    counts = []
    for table, rows in zip(SOURCES, _staged(spark, folder, *SOURCES), strict=True):
        for name, delivery in zip(DELIVERIES, _halves(rows), strict=True):
            _deliver(delivery, f"{drop.folder(table)}/{name}")
        listed = rows_by_file(spark, drop, table)
        delivery = F.element_at(F.split("file_path", "/"), -2).alias("delivery")
        counts.append(
            listed.groupBy(F.lit(table).alias("table_name"), delivery).agg(
                F.sum("rows").alias("row_count"), F.sum("rejected_rows").alias("rejected_rows")
            )
        )
    return reduce(DataFrame.unionByName, counts)


def _new_schemas(spark: SparkSession) -> Schemas:
    """Schemas no other run has, in a folder of their own; nothing that exists is touched."""
    base = scratch_folder(spark, "warehouse")
    schemas = Schemas.prefixed(f"rebuilt_{base.rsplit('-', 1)[-1]}")
    for name in (schemas.raw, schemas.silver, schemas.gold, schemas.work):
        spark.sql(f"CREATE SCHEMA {name} LOCATION '{base}/{name}'")
    return schemas


def warehouse_build(spark: SparkSession, folder: str) -> DataFrame:
    """The whole build over stored raw tables, in new schemas of its own: rows, units and revenue
    of every gold table as stored."""
    schemas = _new_schemas(spark)
    for table, rows in _sources(spark, folder).items():
        rows.write.saveAsTable(f"{schemas.raw}.{table}")
    warehouse.build(spark, schemas=schemas)
    fact = warehouse.gold_table(spark, "fact_orders", schemas)
    tables = {
        name: warehouse.gold_table(spark, name, schemas)
        for name in (*warehouse.STAR_TABLES, *warehouse.MART_TABLES)
    }
    tables["fact_orders"] = fact.withColumns(
        {"total_units_sold": F.col("quantity"), "total_revenue": line_revenue()}
    )

    def total(df: DataFrame, column: str, kind: str) -> Column:
        value = F.sum(column) if column in df.columns else F.lit(None)
        return value.cast(kind)

    return reduce(
        DataFrame.unionByName,
        [
            df.agg(
                F.count("*").alias("row_count"),
                total(df, "total_units_sold", UNITS).alias("units"),
                total(df, "total_revenue", REVENUE).alias("revenue"),
            ).select(F.lit(name).alias("table_name"), "*")
            for name, df in tables.items()
        ],
    )


QUERIES: dict[str, Query] = {
    **{view: _staging_query(table) for view, table in staging.STAGING.items()},
    "dim_client": dim_client,
    "dim_product": dim_product,
    "dim_payment": dim_payment,
    "fact_orders": fact_orders,
    "mart_monthly_sales": _displayed("mart_monthly_sales", _monthly),
    "mart_sales_by_category": _displayed("mart_sales_by_category", _by_category),
    "mart_sales_by_client_type": _displayed("mart_sales_by_client_type", _by_client_type),
    # One row per client: not sorted as a whole, see top_clients.
    "mart_sales_by_client": _by_client,
    "mart_cube_category_month": _displayed("mart_cube_category_month", _cube_category_month),
    "mart_cube_payment_status": _displayed("mart_cube_payment_status", _cube_payment_status),
    "dq_unique": dq_unique,
    "dq_not_null": dq_not_null,
    "dq_relationships": dq_relationships,
    "dq_report": dq_report,
    "row_counts_raw": row_counts_raw,
    "row_counts_star": row_counts_star,
    "kpi_totals": kpi_totals,
    "kpi_cards": kpi_cards,
    "monthly_sales_series": monthly_sales_series,
    "category_revenue_share": category_revenue_share,
    "client_type_revenue": client_type_revenue,
    "cells_category_month": cells_category_month,
    "cells_payment_status": cells_payment_status,
    "heatmap_series": heatmap_series,
    "heatmap_category_month": heatmap_category_month,
    "top_clients": top_clients,
    "client_history": client_history,
    "clients_as_of": clients_as_of,
    "orders_as_of": orders_as_of,
    "sales_by_type_then": sales_by_type_then,
    "order_total_mismatches": order_total_mismatches,
    "quarterly_clients": quarterly_clients,
    "ingest_csv_batch": _ingest_batch("order_product"),
    "ingest_csv_stream": _ingest_stream("orders"),
    **{f"ingest_csv_batch_{t}": _ingest_batch(t) for t in SOURCES if t != "order_product"},
    **{f"ingest_csv_stream_{t}": _ingest_stream(t) for t in SOURCES if t != "orders"},
    "ingest_file_listing": ingest_file_listing,
    "ingest_named_files": ingest_named_files,
    "ingest_freshness": ingest_freshness,
    "ingest_distinct_stream": ingest_distinct_stream,
    "ingest_stream_totals": ingest_stream_totals,
    "warehouse_build": warehouse_build,
    "warehouse_resent": warehouse_resent,
    "warehouse_incremental": warehouse_incremental,
}
