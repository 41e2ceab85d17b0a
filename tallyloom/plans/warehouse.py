"""Building the layers in the catalog: staging as views, gold as tables rebuilt in full."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from tallyloom.model import DESCRIPTIONS, SCHEMAS, SOURCES, Schemas, key_comments
from tallyloom.operators.checks import quality_report
from tallyloom.operators.counts import row_counts
from tallyloom.plans import marts, rollups, staging, star
from tallyloom.session import tune
from tallyloom.sources.csv_files import REJECTED
from tallyloom.streaming import landing

LAYERS = ("silver", "gold")
STAR_TABLES = ("dim_client", "dim_product", "dim_payment", "fact_orders")
MART_TABLES = (
    "mart_monthly_sales",
    "mart_sales_by_category",
    "mart_sales_by_client_type",
    "mart_sales_by_client",
    "mart_cube_category_month",
    "mart_cube_payment_status",
)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def build_silver(spark: SparkSession, schemas: Schemas = SCHEMAS) -> None:
    """Staging views over the raw tables. A view stores nothing and always reads the latest rows."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schemas.silver}")
    for view, table in staging.STAGING.items():
        columns = SOURCES[table].fieldNames()
        comments = key_comments(view)
        described = ", ".join(
            f"{c} COMMENT {_quoted(comments[c])}" if c in comments else c for c in columns
        )
        readable = ""
        if REJECTED in spark.table(f"{schemas.raw}.{table}").columns:
            readable = f" WHERE {REJECTED} IS NULL"
        spark.sql(
            f"CREATE OR REPLACE VIEW {schemas.silver}.{view} ({described}) "
            f"COMMENT {_quoted(DESCRIPTIONS[view])} "
            f"AS SELECT {', '.join(columns)} FROM {schemas.raw}.{table}{readable}"
        )


def _folder(spark: SparkSession, schema: str) -> str:
    return spark.catalog.getDatabase(schema).locationUri.rstrip("/")


def location(spark: SparkSession, table: str) -> str:
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return details.filter("col_name = 'Location'").first().data_type


def store(
    name: str, df: DataFrame, schemas: Schemas = SCHEMAS, schema: str | None = None
) -> DataFrame:
    """Replace a gold table, or one of another schema, and return it as stored.

    The new rows go to whichever of two folders the table does not use now, and the table
    is pointed at them when they are complete. Until then readers see the old rows; a build
    that dies half way leaves them in place, and the next one overwrites what it left.
    """
    spark = df.sparkSession
    schema = schema or schemas.gold
    table = f"{schema}.{name}"
    for column, comment in key_comments(name).items():
        df = df.withMetadata(column, {"comment": comment})

    stored = spark.catalog.tableExists(table)
    used = location(spark, table) if stored else ""
    folder = f"{_folder(spark, schema)}/{name}/{'b' if used.endswith('/a') else 'a'}"
    df.write.mode("overwrite").parquet(folder)

    if stored and spark.table(table).schema.simpleString() != df.schema.simpleString():
        spark.sql(f"DROP TABLE {table}")
        stored = False
    if stored:
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(folder)}")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(
            table, path=folder, source="parquet", schema=df.schema, description=DESCRIPTIONS.get(name, "")
        )
    return spark.table(table)


def _store_all(tables: dict[str, DataFrame], schemas: Schemas) -> dict[str, DataFrame]:
    """Store tables that do not read each other side by side, so they share the cluster."""
    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        stored = pool.map(lambda item: store(*item, schemas), tables.items())
        return dict(zip(tables, stored, strict=True))


def _store_rollup(name: str, rollup: DataFrame, schemas: Schemas = SCHEMAS) -> DataFrame:
    """Replace a work table, bucketed by order, and return it as stored.

    Every mart counts distinct orders or looks at the rows of one order together. One
    shuffle here saves each of them its own. A rollup has no hot order any more, so the
    buckets are even; there are as many as the session has shuffle partitions.
    """
    spark = rollup.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{schemas.work}.{name}"
    (
        rollup.repartition(buckets, "order_id")
        .write.mode("overwrite")
        .format("parquet")
        .option("path", f"{_folder(spark, schemas.work)}/{name}")
        .bucketBy(buckets, "order_id")
        .saveAsTable(table)
    )
    spark.sql(f"COMMENT ON TABLE {table} IS {_quoted(DESCRIPTIONS[name])}")
    return spark.table(table)


def build_gold(spark: SparkSession, schemas: Schemas = SCHEMAS) -> None:
    """Star schema, rollups, then marts.

    Every step reads what the step before it stored, so the join of orders and lines
    runs once, and a lost executor costs at most the tasks of the current step. The two
    rollups feed six marts; they are stored as work tables for the same reason.
    """
    for schema in (schemas.gold, schemas.work):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    stg = {view: spark.table(f"{schemas.silver}.{view}") for view in staging.STAGING}

    base = _store_all(
        {
            "dim_client": star.dim_client(
                stg["stg_client"], stg["stg_client_type"], stg["stg_client_status"]
            ),
            "dim_product": star.dim_product(stg["stg_product"]),
            "dim_payment": star.dim_payment(stg["stg_payment_method"]),
            "fact_orders": star.fact_orders(stg["stg_orders"], stg["stg_order_product"]),
        },
        schemas,
    )
    client, fact = base["dim_client"], base["fact_orders"]
    sales = _store_rollup("order_sales", rollups.order_sales(fact), schemas)
    category_sales = _store_rollup(
        "category_sales", rollups.category_sales(fact, base["dim_product"]), schemas
    )
    _store_all(
        {
            "mart_monthly_sales": marts.mart_monthly_sales(sales),
            "mart_sales_by_category": marts.mart_sales_by_category(category_sales),
            "mart_sales_by_client_type": marts.mart_sales_by_client_type(sales, client),
            "mart_sales_by_client": marts.mart_sales_by_client(sales, client),
            "mart_cube_category_month": marts.mart_cube_category_month(category_sales),
            "mart_cube_payment_status": marts.mart_cube_payment_status(
                sales, base["dim_payment"]
            ),
        },
        schemas,
    )


def build(
    spark: SparkSession, layers: Iterable[str] = LAYERS, schemas: Schemas = SCHEMAS
) -> None:
    """Build the chosen layers from the tables of the raw schema."""
    chosen = set(layers)
    if unknown := chosen - set(LAYERS):
        raise ValueError(f"unknown layers: {sorted(unknown)}")
    tune(spark)
    landing.refresh(spark, schemas=schemas)
    if "silver" in chosen:
        build_silver(spark, schemas)
    if "gold" in chosen:
        build_gold(spark, schemas)


def gold_table(spark: SparkSession, name: str, schemas: Schemas = SCHEMAS) -> DataFrame:
    return spark.table(f"{schemas.gold}.{name}")


def stored_order_sales(spark: SparkSession, schemas: Schemas = SCHEMAS) -> DataFrame:
    """Units and revenue per order, as of the last build; the input of the overall totals."""
    return spark.table(f"{schemas.work}.order_sales")


def tested_models(spark: SparkSession, schemas: Schemas = SCHEMAS) -> dict[str, DataFrame]:
    silver = {view: spark.table(f"{schemas.silver}.{view}") for view in staging.STAGING}
    return silver | {name: gold_table(spark, name, schemas) for name in STAR_TABLES}


def check(spark: SparkSession, schemas: Schemas = SCHEMAS) -> DataFrame:
    """The quality report of the built warehouse."""
    return quality_report(tested_models(spark, schemas))


def audit_raw(spark: SparkSession, schemas: Schemas = SCHEMAS) -> DataFrame:
    """Row counts of the raw tables, right after loading; no layer need be built."""
    return row_counts(landing.raw_tables(spark, schemas))


def audit_star(spark: SparkSession, schemas: Schemas = SCHEMAS) -> DataFrame:
    """Row counts of the star schema."""
    return row_counts({name: gold_table(spark, name, schemas) for name in STAR_TABLES})


def audit(spark: SparkSession, schemas: Schemas = SCHEMAS) -> tuple[DataFrame, DataFrame]:
    return audit_raw(spark, schemas), audit_star(spark, schemas)
