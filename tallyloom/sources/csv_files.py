"""Typed reading of delivered CSV files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from tallyloom.model import SOURCES

# Text of a record that does not fit its table's schema; NULL for a good row.
REJECTED = "rejected_record"
_MALFORMED = "_corrupt_record"

# What a whole cell must look like to have a value of its type. A cast alone would read a
# beginning (``2024-06-01 junk``) or round (``2.06`` to one place) and pass for clean.
_BLANK = r"\s*"
_WHOLE = rf"^{_BLANK}[+-]?\d+{_BLANK}$"
_DAY = r"\d{4}-\d{2}-\d{2}"
_DATE = rf"^{_BLANK}{_DAY}{_BLANK}$"
_TIMESTAMP = rf"^{_BLANK}{_DAY}([ T]\d{{2}}:\d{{2}}(:\d{{2}}(\.\d{{1,6}})?)?)?{_BLANK}$"

# Columns are matched by position, the header line is only skipped. Two texts mean
# NULL: "NULL" and the empty string, quoted or not. Without column pruning a missing or
# surplus cell is noticed whatever columns a query asks for.
CSV_OPTIONS = {
    "header": "true",
    "enforceSchema": "true",
    "sep": ",",
    "nullValue": "NULL",
    "emptyValue": "NULL",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _MALFORMED,
    "columnPruning": "false",
}

# A record is written so that CSV_OPTIONS read it back into the same cells.
RECORD_OPTIONS = {
    "nullValue": "NULL",
    "emptyValue": '""',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


@dataclass(frozen=True)
class FileDrop:
    """A base folder into which files named ``<table>__<stamp>.csv`` are delivered.

    With ``by_table`` every table has its own sub-folder; otherwise all files lie in
    one flat folder. ``pattern`` is matched against the start of the file name, so
    ``product__*`` never picks up ``order_product__*``.
    """

    base: str
    by_table: bool = True
    pattern: str = "{table}__*"

    def folder(self, table: str) -> str:
        base = self.base.rstrip("/")
        return f"{base}/{table}" if self.by_table else base

    def name_filter(self, table: str) -> str:
        return self.pattern.format(table=table)


def folder_exists(spark: SparkSession, folder: str) -> bool:
    """Whether anything has been delivered yet; object stores have no empty folders."""
    try:
        spark.read.format("binaryFile").option("pathGlobFilter", "-").load(folder).schema
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def with_rejects(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType(), True)])


def read_cells(
    reader: DataFrameReader | DataStreamReader, drop: FileDrop, table: str
) -> DataFrame:
    """The files of a table as text cells, alike for batch and stream."""
    cells = [T.StructField(name, T.StringType(), True) for name in SOURCES[table].fieldNames()]
    malformed = T.StructField(_MALFORMED, T.StringType(), True)
    return (
        reader.schema(T.StructType([*cells, malformed]))
        .options(**CSV_OPTIONS)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", drop.name_filter(table))
        .csv(drop.folder(table))
    )


def fits(cell: Column, kind: T.DataType) -> Column:
    """Whether the whole text of a cell has the form of its type."""
    if isinstance(kind, T.LongType):
        return cell.rlike(_WHOLE)
    if isinstance(kind, T.DateType):
        return cell.rlike(_DATE)
    if isinstance(kind, T.TimestampNTZType):
        return cell.rlike(_TIMESTAMP)
    if isinstance(kind, T.DecimalType):
        # More places than the column has may only be zeros.
        places = rf"\d{{0,{kind.scale}}}0*"
        return cell.rlike(rf"^{_BLANK}[+-]?(\d+(\.{places})?|\.(?=\d){places}){_BLANK}$")
    return F.lit(True)


def typed(cells: DataFrame, table: str) -> DataFrame:
    """Declared columns, and the record text of every row that does not fit them.

    The CSV reader only converts the columns a query uses, so its own verdict on a row
    changes with the query. Cells are therefore read as text and converted here: a row
    is rejected if any cell has a text that is not, as a whole, a value of its type, or if
    it has too few or too many cells. A rejected row is kept as one CSV record that the same
    options read back into the same cells.

    Columns that are not declared, such as where a row came from, are kept behind.
    """
    fields = SOURCES[table].fields
    names = [f.name for f in fields]
    values = {f.name: F.col(f.name).try_cast(f.dataType) for f in fields}
    unfit = F.col(_MALFORMED).isNotNull()
    for f in fields:
        cell = F.col(f.name)
        bad = values[f.name].isNull() | ~fits(cell, f.dataType)
        unfit = unfit | (cell.isNotNull() & bad)
    as_read = F.to_csv(F.struct(*names), RECORD_OPTIONS)
    record = F.when(unfit, F.coalesce(F.col(_MALFORMED), as_read))
    others = [c for c in cells.columns if c not in (*names, _MALFORMED)]
    return cells.select(
        *[value.alias(name) for name, value in values.items()], record.alias(REJECTED), *others
    )


def read_delivered(spark: SparkSession, drop: FileDrop, table: str) -> DataFrame:
    """All delivered rows, good and bad, as one batch; none if the folder does not exist yet."""
    if not folder_exists(spark, drop.folder(table)):
        return spark.createDataFrame([], with_rejects(SOURCES[table]))
    return typed(read_cells(spark.read, drop, table), table)


def accepted(rows: DataFrame, table: str) -> DataFrame:
    """Rows that fit their schema, with the declared columns."""
    return rows.filter(F.col(REJECTED).isNull()).select(*SOURCES[table].fieldNames())


def rejected(rows: DataFrame) -> DataFrame:
    """The text of rows with a bad cell, a missing cell or a surplus cell."""
    return rows.filter(F.col(REJECTED).isNotNull()).select(F.col(REJECTED).alias("record"))


def tables_from_csv(spark: SparkSession, drop: FileDrop) -> dict[str, DataFrame]:
    return {table: accepted(read_delivered(spark, drop, table), table) for table in SOURCES}


def rows_by_file(spark: SparkSession, drop: FileDrop, table: str) -> DataFrame:
    """Delivered files of a table, with their size, time, and good and bad rows."""
    where = F.col("_metadata")
    cells = read_cells(spark.read, drop, table).select(
        "*",
        where["file_path"].alias("file_path"),
        where["file_size"].alias("file_size"),
        where["file_modification_time"].alias("file_time"),
    )
    return (
        typed(cells, table)
        .groupBy("file_path", "file_size", "file_time")
        .agg(F.count("*").alias("rows"), F.count(REJECTED).alias("rejected_rows"))
    )


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Path, size and modification time of the files below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    )
