"""The seven source tables, derived from the TPC-H-like benchmark tables.

Every table is one scan with projections, so that a query's cost is its own. Ids are
64-bit and money is decimal, as in the declared source schemas.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.model import SOURCES

# Columns used, with their stored types: declared, so that no file is opened to infer them.
_STORED = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double"
    ),
    "part": "p_partkey bigint, p_name string, p_type string, p_retailprice double",
}


def _decimal(whole: Column, unit: str, kind: str) -> Column:
    """A whole number of units, such as cents, as an exact decimal.

    Spark turns a double into a decimal by way of its text; from a long it is much cheaper.
    """
    digits = len(unit) - 2
    step = F.lit(unit).cast(f"decimal({digits},{digits})")
    return (whole.cast("decimal(13,0)") * step).cast(kind)


def _client(read: Callable[[str], DataFrame]) -> DataFrame:
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    mailbox = F.lower(F.replace("c_name", F.lit("#"), F.lit(".")))
    last_digits = F.lpad((key % 10000).cast("string"), 4, "0")
    return read("customer").select(
        key.alias("client_id"),
        F.col("c_name").alias("client_name"),
        F.concat(mailbox, F.lit("@"), F.lower(segment), F.lit(".example")).alias("email"),
        F.concat(F.lit("(555) 000-"), last_digits).alias("phone_number"),
        F.concat(key.cast("string"), F.lit(" "), segment, F.lit(" St")).alias("address"),
        F.col("c_nationkey").cast("bigint").alias("type_id"),
        (key % 7).alias("status_id"),
        F.date_add(F.lit("2018-01-01").cast("date"), (key % 1000).cast("int"))
        .cast("timestamp_ntz")
        .alias("registration_date"),
    )


def _client_status(read: Callable[[str], DataFrame]) -> DataFrame:
    return read("region").select(
        F.col("r_regionkey").cast("bigint").alias("client_status_id"),
        F.col("r_name").alias("status_name"),
    )


def _client_type(read: Callable[[str], DataFrame]) -> DataFrame:
    return read("nation").select(
        F.col("n_nationkey").cast("bigint").alias("client_type_id"),
        F.col("n_name").alias("type_name"),
    )


def _orders(read: Callable[[str], DataFrame]) -> DataFrame:
    return read("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("client_id"),
        F.left("o_orderpriority", F.lit(1)).cast("bigint").alias("payment_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
        _decimal(
            F.rint(F.col("o_totalprice") * 100).cast("bigint"), "0.01", "decimal(10,2)"
        ).alias("total_amount"),
    )


def _order_product(read: Callable[[str], DataFrame]) -> DataFrame:
    # Unit price is the line's price over its quantity, cut to whole cents. Cutting
    # instead of rounding gives the same value in any engine with IEEE doubles.
    cents = F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100)
    tenths = F.rint(F.col("l_quantity") * 10).cast("bigint")
    return read("lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_product_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        _decimal(tenths, "0.1", "decimal(10,1)").alias("quantity"),
        _decimal(cents, "0.01", "decimal(10,2)").alias("price_unit"),
    )


def _product(read: Callable[[str], DataFrame]) -> DataFrame:
    return read("part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
    )


def _payment_method(read: Callable[[str], DataFrame]) -> DataFrame:
    methods = read("orders").select("o_orderpriority").distinct()
    # Spark learns the size of this lookup from its own shuffle and joins accordingly.
    return methods.select(
        F.left("o_orderpriority", F.lit(1)).cast("bigint").alias("payment_id"),
        F.split_part("o_orderpriority", F.lit("-"), F.lit(2)).alias("payment_method"),
    )


# Stamps of four deliveries of clients, as in file names: the day before the month.
CLIENT_DELIVERIES = ("1995_30_06_08_00", "1996_15_09_13_50", "1998_01_03_14_37", "2000_20_01_09_05")


def client_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """Clients as sent over time, with ``delivered_at``: the first delivery has most of them, a
    later one every second, third or fourth, some with another type or status, some unchanged."""
    clients = load(spark, folder, ["client"])["client"]
    key, n = F.col("client_id"), F.col("n")
    sends = (
        F.when(n == 0, key % 5 != 4).when(n == 1, (key % 2 == 0) | (key % 5 == 4)).otherwise(key % (n + 1) == 0)
    )
    stamp = F.element_at(F.array(*map(F.lit, CLIENT_DELIVERIES)), n + 1)
    sent = clients.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(3)))).filter(sends)
    return sent.withColumns(
        {
            "type_id": (F.col("type_id") + n * (key % 3)) % 25,
            "status_id": (F.col("status_id") + F.floor(n / 2)) % 7,
            "delivered_at": F.to_timestamp_ntz(stamp, F.lit("yyyy_dd_MM_HH_mm")),
        }
    ).drop("n")


_DERIVATIONS: dict[str, Callable[[Callable[[str], DataFrame]], DataFrame]] = {
    "client": _client,
    "client_status": _client_status,
    "client_type": _client_type,
    "orders": _orders,
    "order_product": _order_product,
    "product": _product,
    "payment_method": _payment_method,
}

# The file each table is derived from.
_FILES = {
    "client": "customer",
    "client_status": "region",
    "client_type": "nation",
    "orders": "orders",
    "order_product": "lineitem",
    "product": "part",
    "payment_method": "orders",
}


def _path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def file_bytes(spark: SparkSession, folder: str, tables: Iterable[str] = tuple(SOURCES)) -> int:
    """The size of the Parquet files behind the named source tables."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    paths = [hadoop.Path(_path(folder, name)) for name in {_FILES[table] for table in tables}]
    return sum(path.getFileSystem(settings).getContentSummary(path).getLength() for path in paths)


def load(
    spark: SparkSession, folder: str, tables: Iterable[str] = tuple(SOURCES)
) -> dict[str, DataFrame]:
    """The named source tables over the Parquet files in ``folder``."""

    def read(name: str) -> DataFrame:
        return spark.read.schema(_STORED[name]).parquet(_path(folder, name))

    return {table: _DERIVATIONS[table](read) for table in tables}
