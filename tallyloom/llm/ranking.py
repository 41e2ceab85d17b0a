"""Places of rows in a global order, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.tables import stored

# Fixed value: the bits Spark gives the row number below the partition number.
ROW_BITS = 33


def numbered(rows: DataFrame, group: str, order: Sequence[Column], name: str = "place") -> DataFrame:
    """The rows with their place, from 0, among the rows of their group in this order.

    Rows are dealt by ranges of (group, order), so that a hot group is spread over many
    tasks; its parts are counted and each part starts where the parts before it end. Only
    one row for every part of a group, not its rows, meets in one window.

    Defined cases: a null group is a group; rows alike in group and order get their places
    in any order; no rows give no rows. The last of `order` should tell such rows apart
    if there are many, else they share a task. The result is stored.
    """
    spark = rows.sparkSession
    keys = [F.col(group), *order]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    dealt = stored(dealt.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", ROW_BITS).alias("_part")
    runs = dealt.groupBy(F.col(group).alias("_group"), part).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n")
    )
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    placed = dealt.join(
        runs, (F.shiftright("_at", ROW_BITS) == F.col("_part")) & F.col(group).eqNullSafe(F.col("_group"))
    )
    place = F.col("_at") - F.col("_first") + F.col("_before")
    return placed.select(*[F.col(c) for c in rows.columns], place.alias(name))
