"""Append-only loading of delivered CSV files, each file exactly once.

One streaming query per table lands every row, the text of unreadable ones included, with
the file it came from and the number of its micro-batch. Every micro-batch has a folder of
its own, which is written anew if the batch is repeated, so a repeat changes nothing.
Accepted and rejected rows, and the progress of the load, are views on what has landed.

Run it on a schedule: each run takes what has arrived since the last one, the first run
everything already there. A file is known by its path; the same content under a new
name is loaded again, and the uniqueness checks report it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyloom.model import SCHEMAS, SOURCES, Schemas
from tallyloom.sources.csv_files import (
    REJECTED,
    FileDrop,
    accepted,
    folder_exists,
    read_cells,
    rejected,
    typed,
    with_rejects,
)

# Spark by default ignores files a week older than the newest one seen. A late file must
# not be lost, so the limit is raised out of reach.
MAX_FILE_AGE = "36500d"

# Where a landed row came from.
ORIGIN = [
    T.StructField("source_file", T.StringType(), True),
    T.StructField("file_time", T.TimestampType(), True),
    T.StructField("batch_id", T.LongType(), True),
]


class LandingFailed(RuntimeError):
    """One or more tables failed; the others have been loaded."""


def landed_schema(table: str) -> T.StructType:
    return T.StructType([*with_rejects(SOURCES[table]).fields, *ORIGIN])


def _write_batch(folder: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
        rows.write.mode("overwrite").parquet(f"{folder}/batch-{batch_id:012d}")

    return write


def start_landing(
    spark: SparkSession,
    drop: FileDrop,
    table: str,
    landing: str,
    checkpoints: str,
    files_per_batch: int = 1000,
    distinct_within: str | None = None,
) -> StreamingQuery:
    """Start loading what has arrived for one table; the query ends when it is done.

    With ``distinct_within`` (such as ``7 days``) a row that arrived before, alike in every
    cell, within that time is not landed again, whatever the name of its file. Time is that of
    arrival here, so that no late file is taken for an old one. The state holds the rows
    of that time; a repeat after it is landed, and :func:`repeated_rows` reports it.

    ``files_per_batch`` bounds a micro-batch, so that a large backlog is committed in
    steps and an interrupted run resumes where it stopped. Batches are numbered by the
    checkpoint: without the checkpoint that numbered what has landed, the load is refused.
    """
    folder, checkpoint = f"{landing}/{table}", f"{checkpoints}/{table}"
    if folder_exists(spark, folder) and not folder_exists(spark, checkpoint):
        raise ValueError(f"{folder} has rows, but its checkpoint {checkpoint} is missing")
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch).option(
        "maxFileAge", MAX_FILE_AGE
    )
    where = F.col("_metadata")
    cells = read_cells(reader, drop, table).select(
        "*",
        where["file_path"].alias("source_file"),
        where["file_modification_time"].alias("file_time"),
    )
    rows = typed(cells, table)
    if distinct_within:
        content = with_rejects(SOURCES[table]).fieldNames()
        rows = rows.withColumn("arrived_at", F.current_timestamp()).withWatermark("arrived_at", distinct_within)
        rows = rows.dropDuplicatesWithinWatermark(content).drop("arrived_at")
    return (
        rows.writeStream.foreachBatch(_write_batch(folder))
        .option("checkpointLocation", checkpoint)
        .queryName(f"land_{table}")
        .trigger(availableNow=True)
        .start()
    )


def land(
    spark: SparkSession,
    drop: FileDrop,
    landing: str,
    checkpoints: str,
    tables: Iterable[str] = tuple(SOURCES),
    files_per_batch: int = 1000,
    schemas: Schemas = SCHEMAS,
    distinct_within: str | None = None,
) -> None:
    """Load all tables side by side and wait for all; then raise if any of them failed.

    A table whose folder does not exist yet is left out.
    """
    tables = [table for table in tables if folder_exists(spark, drop.folder(table))]
    queries = [
        start_landing(spark, drop, table, landing, checkpoints, files_per_batch, distinct_within)
        for table in tables
    ]
    failures = []
    for query in queries:
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            failures.append(f"{query.name}: {error}")
    refresh(spark, tables, schemas)
    if failures:
        raise LandingFailed("\n".join(failures))


def refresh(
    spark: SparkSession, tables: Iterable[str] = tuple(SOURCES), schemas: Schemas = SCHEMAS
) -> None:
    """Let this session's registered tables see newly landed files."""
    for table in tables:
        if spark.catalog.tableExists(f"{schemas.raw}.{table}"):
            spark.catalog.refreshTable(f"{schemas.raw}.{table}")


def landed(spark: SparkSession, landing: str, table: str) -> DataFrame:
    if not folder_exists(spark, f"{landing}/{table}"):
        return spark.createDataFrame([], landed_schema(table))
    # What an unfinished attempt has written is not visible below a batch's folder.
    reader = spark.read.schema(landed_schema(table)).option("recursiveFileLookup", "true")
    return reader.parquet(f"{landing}/{table}")


def landed_rows(spark: SparkSession, landing: str, table: str) -> DataFrame:
    return accepted(landed(spark, landing, table), table)


def landed_rejects(spark: SparkSession, landing: str, table: str) -> DataFrame:
    return rejected(landed(spark, landing, table))


def repeated_rows(spark: SparkSession, landing: str, table: str) -> DataFrame:
    """Rows that have landed more than once, alike in every cell: how often, and from how many files."""
    content = with_rejects(SOURCES[table]).fieldNames()
    times = landed(spark, landing, table).groupBy(*content).agg(
        F.count("*").alias("times"), F.count_distinct("source_file").alias("files")
    )
    return times.filter("times > 1")


def landing_status(
    spark: SparkSession, landing: str, tables: Iterable[str] = tuple(SOURCES)
) -> DataFrame:
    """What each file brought: one row per table, batch and file with rows, however many.

    It is counted from what has landed, so no file that a query reads can be missing.
    """
    found = [
        landed(spark, landing, table)
        .groupBy("batch_id", "source_file", "file_time")
        .agg(F.count("*").alias("input_rows"), F.count(REJECTED).alias("rejected_rows"))
        .select(F.lit(table).alias("table_name"), "*")
        for table in tables
    ]
    return reduce(DataFrame.unionByName, found)


def create_raw_tables(spark: SparkSession, landing: str, schemas: Schemas = SCHEMAS) -> None:
    """Register the landing folders as typed tables, empty until the first load."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schemas.raw}")
    for table in SOURCES:
        name = f"{schemas.raw}.{table}"
        if not spark.catalog.tableExists(name):
            spark.catalog.createTable(
                name,
                path=f"{landing}/{table}",
                source="parquet",
                schema=landed_schema(table),
                recursiveFileLookup="true",
            )


def raw_tables(spark: SparkSession, schemas: Schemas = SCHEMAS) -> dict[str, DataFrame]:
    """The accepted rows of the raw tables, as of now; loaded by this module or by others."""
    refresh(spark, schemas=schemas)
    rows = {table: spark.table(f"{schemas.raw}.{table}") for table in SOURCES}
    return {
        table: accepted(df, table) if REJECTED in df.columns else df for table, df in rows.items()
    }


def raw_rejects(spark: SparkSession, schemas: Schemas = SCHEMAS) -> DataFrame:
    """Unreadable records of all tables, with the table they were delivered for."""
    found = [
        rejected(spark.table(f"{schemas.raw}.{table}")).select(
            F.lit(table).alias("table_name"), "record"
        )
        for table in SOURCES
    ]
    return reduce(DataFrame.unionByName, found)
