"""Silver layer: one projection per source table, clear and unmasked."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyloom.model import SOURCES

STAGING = {f"stg_{table}": table for table in SOURCES}


def stage(table: str, source: DataFrame) -> DataFrame:
    """The declared columns of a source table, by name and in order."""
    return source.select(*SOURCES[table].fieldNames())
