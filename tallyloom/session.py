"""Session settings the pipeline relies on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# forceOptimizeSkewedJoin: without it a hot order id is not split when the step
# after the join reuses the join's partitioning; with it the extra shuffle is paid
# only by joins that really are skewed.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# A task holds its rows in hash tables and sorts, at many times their size in a file or a
# shuffle. So it gets a small split of a file, and shuffled parts are joined to small ones:
# with more rows there are more tasks, not larger ones.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": 16 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20,
}

# Adaptive execution joins small parts of a shuffle but splits no large ones, so there are
# enough parts from the start: one for this much of the files that are read.
FILE_BYTES_A_PART = 2 << 20

_PARTS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

_UNITS = {unit: 1 << 10 * power for power, unit in enumerate(("b", "k", "m", "g", "t", "p"))}


def _bytes(size: str) -> int:
    """A size as sessions write it: ``134217728``, ``64MB``, ``16m``."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([bkmgtp]?)b?\s*", size.lower()).groups()
    return int(number) * _UNITS[unit or "b"]


def tune(spark: SparkSession) -> SparkSession:
    """Apply the adaptive-execution settings to a session that already exists.

    Sizes of tasks are only ever lowered; a session with smaller ones keeps them.
    """
    for key, value in ADAPTIVE_SETTINGS.items():
        spark.conf.set(key, value)
    for key, most in TASK_BYTES.items():
        if _bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    return spark


def spread(spark: SparkSession, file_bytes: int) -> None:
    """Parts of a shuffle by the size of the files behind it; their number is only ever raised.

    With more parts than the sizes of are told one by one, hot keys would go unnoticed.
    """
    told = int(spark.sparkContext.getConf().get("spark.shuffle.minNumPartitionsToHighlyCompress", "2000"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(parts, min(told, -(-file_bytes // FILE_BYTES_A_PART)))
    if wanted > int(spark.conf.get(_PARTS, None) or parts):
        spark.conf.set(_PARTS, str(wanted))


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    It lies below the cluster's ``spark.checkpoint.dir``. Only a local session, where
    driver and executors share one disk, may fall back to the temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tallyloom-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as they are now, written to the shared folder and read back.

    For a small result that is looked at more than once: unlike a cache it is not mistaken
    for the result of a later query, and no executor has to live on for it.
    """
    folder = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
