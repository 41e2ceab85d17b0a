"""Rows delivered again and again: the latest of each key, all versions, and any day's state.

A delivery is a set of rows with the time it was made. A row of a later delivery replaces the
row of the same key; keys a delivery does not name stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_rows(rows: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The columns of the row of each key that is last in the order.

    Map tasks keep one row a key, so a key that was sent very often is reduced before any
    shuffle. Of rows equal in the order the one with the greatest columns stays, whatever
    the partitioning. Rows without a key replace nothing and all stay.
    """
    others = [c for c in columns if c != key]
    newest = F.max(F.struct(*order, *[F.col(c).alias(f"_{c}") for c in others]))
    known = (
        rows.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(newest.alias("_newest"))
        .select(key, *[F.col(f"_newest._{c}").alias(c) for c in others])
    )
    return known.select(*columns).unionByName(rows.filter(F.col(key).isNull()).select(*columns))


def version_history(rows: DataFrame, key: str, at: str, columns: Sequence[str]) -> DataFrame:
    """One row for each version of a key, with the interval it holds in.

    ``valid_from`` is the delivery that brought it, ``valid_to`` the one that brought the next,
    not included; NULL while it is current. A row sent again unchanged opens no version, so
    intervals of a key neither overlap nor leave a gap. Several rows of one key in one
    delivery count as one, the greatest. The order in which deliveries were loaded does not
    matter. Rows without a key or a time have no history.

    Rows of one key meet in one task after they were reduced to one for each delivery.
    """
    others = [c for c in columns if c != key]
    sent = (
        rows.filter(F.col(key).isNotNull() & F.col(at).isNotNull())
        .groupBy(key, F.col(at).alias("valid_from"))
        .agg(F.max(F.struct(*others)).alias("_row"))
    )
    in_time = Window.partitionBy(key).orderBy("valid_from")
    before = F.lag("_row").over(in_time)
    # Compared value by value, NULL equal to NULL; a first version has nothing before it.
    opens = before.isNull() | ~before.eqNullSafe(F.col("_row"))
    versions = sent.withColumn("_opens", opens).filter("_opens")
    return versions.select(
        key,
        *[F.col(f"_row.{c}").alias(c) for c in others],
        F.row_number().over(in_time).alias("version"),
        "valid_from",
        F.lead("valid_from").over(in_time).alias("valid_to"),
        F.lead("valid_from").over(in_time).isNull().alias("is_current"),
    )


def as_of(history: DataFrame, moment: date | datetime) -> DataFrame:
    """The versions that held at a moment, one for each key known by then."""
    now = F.lit(moment).cast("timestamp_ntz")
    held = (F.col("valid_from") <= now) & (F.col("valid_to").isNull() | (now < F.col("valid_to")))
    return history.filter(held).drop("version", "valid_from", "valid_to", "is_current")
