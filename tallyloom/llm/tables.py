"""Reading and storing tables for the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import scratch_folder


ROWS_A_BATCH = 1000


def bounded(spark: SparkSession) -> SparkSession:
    """The session with small Arrow batches: a Python worker holds few texts at a time.

    It lowers one session setting, which limits memory and changes no result; whole texts
    are handed over however small the batches are.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= ROWS_A_BATCH:
        spark.conf.set(setting, str(ROWS_A_BATCH))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back: later steps neither repeat
    the work nor depend on the executors that did it."""
    spark = df.sparkSession
    folder = scratch_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def learns(doc_id: Column | str) -> Column:
    """Rows whose labels a model may see; the others are held out."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(key.cast("string")), F.lit(5)) != 0
