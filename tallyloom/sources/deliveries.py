"""When a file was delivered, by its name, and what became of every delivered file."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.model import SOURCES
from tallyloom.sources.csv_files import FileDrop, folder_exists, rows_by_file

# Fixed values: ``<table>__YYYY_DD_MM_HH_mm.csv``, the day before the month.
STAMP = r"__(\d{4})_(\d{2})_(\d{2})_(\d{2})_(\d{2})(?:[^\d/][^/]*)?$"

REPORT = "table_name string, file_path string, delivered_at timestamp_ntz, file_size long"


def delivered_at(path: Column) -> Column:
    """The time in a file's name; NULL if there is none or it is no time."""
    year, day, month, hour, minute = (F.regexp_extract(path, STAMP, n).try_cast("int") for n in range(1, 6))
    # Without a zone: a time that clocks skip in some zone is a time like any other.
    return F.try_make_timestamp_ntz(year, month, day, hour, minute, F.lit(0).cast("decimal(8,6)"))


def delivered_files(
    spark: SparkSession, drop: FileDrop, tables: Iterable[str] = tuple(SOURCES)
) -> DataFrame:
    """Every delivered file by table, those without rows included; contents are not read."""
    found = [spark.createDataFrame([], REPORT)]
    for table in tables:
        if not folder_exists(spark, drop.folder(table)):
            continue
        where = F.col("_metadata")
        found.append(
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", drop.name_filter(table))
            .load(drop.folder(table))
            .select(
                F.lit(table).alias("table_name"),
                where["file_path"].alias("file_path"),
                delivered_at(where["file_path"]).alias("delivered_at"),
                where["file_size"].alias("file_size"),
            )
        )
    return reduce(DataFrame.unionByName, found)


def delivery_status(
    spark: SparkSession, drop: FileDrop, status: DataFrame, tables: Iterable[str] = tuple(SOURCES)
) -> DataFrame:
    """Each delivered file with its rows and whether it is ``loaded``, ``empty`` (a header and no
    row: nothing to load) or ``waiting``.

    ``status`` is the load status of the landing. Files that have not landed are told
    apart by their own rows.
    """
    tables = list(tables)
    files = delivered_files(spark, drop, tables)
    landed = status.groupBy("table_name", F.col("source_file").alias("file_path")).agg(
        F.sum("input_rows").alias("landed_rows"), F.sum("rejected_rows").alias("rejected_rows")
    )
    filled = [spark.createDataFrame([], "table_name string, file_path string, rows long")]
    for table in tables:
        if folder_exists(spark, drop.folder(table)):
            rows = rows_by_file(spark, drop, table)
            filled.append(rows.select(F.lit(table).alias("table_name"), "file_path", "rows"))
    both = ["table_name", "file_path"]
    report = files.join(reduce(DataFrame.unionByName, filled), both, "left").join(landed, both, "left")
    state = F.when(F.col("landed_rows").isNotNull(), "loaded").when(F.col("rows") > 0, "waiting")
    return report.select(
        *both,
        "delivered_at",
        "file_size",
        F.coalesce("rows", F.lit(0)).alias("row_count"),
        F.coalesce("landed_rows", F.lit(0)).alias("landed_rows"),
        F.coalesce("rejected_rows", F.lit(0)).alias("rejected_rows"),
        state.otherwise("empty").alias("state"),
    )


def freshness(
    files: DataFrame, now: datetime, limit: timedelta, tables: Iterable[str] = tuple(SOURCES)
) -> DataFrame:
    """The newest delivery of every table at a moment, and whether it is within the limit.

    ``files`` has (table_name, delivered_at), one row a file. Deliveries dated after the
    moment do not count; a table without any is not fresh, with NULL for its newest delivery
    and its age; files without a time in their name are counted apart.
    """
    spark = files.sparkSession
    named = spark.createDataFrame([(t,) for t in tables], "table_name string")
    moment = F.lit(now).cast("timestamp_ntz")
    known = files.filter(F.col("delivered_at").isNull() | (F.col("delivered_at") <= moment))
    newest = known.groupBy("table_name").agg(
        F.max("delivered_at").alias("newest_delivery"),
        F.count("delivered_at").alias("deliveries"),
        F.count_if(F.col("delivered_at").isNull()).alias("unstamped_files"),
    )
    minutes = F.timestamp_diff("MINUTE", F.col("newest_delivery"), moment)
    most = int(limit.total_seconds() // 60)
    return named.join(newest, "table_name", "left").select(
        "table_name",
        "newest_delivery",
        F.coalesce("deliveries", F.lit(0)).alias("deliveries"),
        F.coalesce("unstamped_files", F.lit(0)).alias("unstamped_files"),
        minutes.alias("age_minutes"),
        F.coalesce(minutes <= most, F.lit(False)).alias("fresh"),
    )
