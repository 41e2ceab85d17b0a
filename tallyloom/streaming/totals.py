"""Sales totals kept up to date while sales arrive, with late ones set aside.

A sale is one order with its date, units and revenue. The event time is the order's date; the
watermark is the latest date seen in earlier micro-batches, less the lateness allowed. What
is older than the watermark when it arrives is late: it does not change the totals but
is written beside them, so that totals and late sales together are all that arrived.

The state is a running sum for each month and one of a fixed number of shares of the orders,
so a month in which very much is sold is kept by many tasks and the state has a row a month
and share. Every micro-batch writes its changed sums and its late sales to folders of its own,
which are written anew if the batch is repeated; the totals are the latest sums, added up.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyloom.functions.measures import REVENUE, UNITS
from tallyloom.sources.csv_files import folder_exists

SHARES = 32
LATENESS = "31 days"
EVENT_DATES = (date(1700, 1, 1), date(2262, 1, 1))
SALES = "order_id long, order_date date, units decimal(38,1), revenue decimal(38,3)"

# Exact whole numbers in the state: tenths of units and thousandths of revenue.
_SUMS = "orders long, tenths long, mils long"
_CHANGES = f"month date, share int, {_SUMS}, late_order long, late_date date, late_tenths long, late_mils long"


def _count(
    key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
) -> Iterator[pd.DataFrame]:
    """New sums of one month and share, and its late sales."""
    sums = list(state.get) if state.exists else [0, 0, 0]
    bound = state.getCurrentWatermarkMs()
    late, changed = [], False
    for rows in batches:
        behind = rows["event_ms"] < bound
        late.append(rows[behind])
        on_time = rows[~behind]
        if len(on_time):
            changed = True
            sums[0] += len(on_time)
            sums[1] += sum(map(int, on_time["tenths"]))
            sums[2] += sum(map(int, on_time["mils"]))
    if changed:
        state.update(tuple(sums))
    month, share = key
    set_aside = pd.concat(late)
    out = pd.DataFrame(
        {
            "orders": None, "tenths": None, "mils": None, "late_order": set_aside["order_id"],
            "late_date": set_aside["order_date"], "late_tenths": set_aside["tenths"], "late_mils": set_aside["mils"],
        }
    )
    if changed:
        now = {"orders": sums[0], "tenths": sums[1], "mils": sums[2]}
        out = pd.concat([out.astype(object), pd.DataFrame([now], dtype=object)])
    out.insert(0, "share", share)
    out.insert(0, "month", month)
    yield out


def start_totals(
    spark: SparkSession, sales: str, totals: str, checkpoint: str, lateness: str = LATENESS
) -> StreamingQuery:
    """Add what has arrived in the folder of sales (Parquet) to the totals; ends when it is done.

    Sales without a date are of no month and, having no event time, count as late.
    """
    # Within what a Python timestamp can hold; a date beyond moves the watermark no further.
    event = F.coalesce("order_date", F.lit(EVENT_DATES[0]))
    event = F.least(F.greatest(event, F.lit(EVENT_DATES[0])), F.lit(EVENT_DATES[1]))
    dated = (
        spark.readStream.schema(SALES)
        .parquet(sales)
        .withColumn("event", event.cast("timestamp"))
        .withWatermark("event", lateness)
        .select(
            F.trunc("order_date", "MM").alias("month"),
            F.pmod(F.xxhash64("order_id"), F.lit(SHARES)).cast("int").alias("share"),
            "order_id",
            "order_date",
            (F.coalesce("units", F.lit(0)) * 10).cast("long").alias("tenths"),
            (F.coalesce("revenue", F.lit(0)) * 1000).cast("long").alias("mils"),
            F.when(F.col("order_date").isNull(), F.lit(-(1 << 62)))
            .otherwise(F.unix_millis(F.col("order_date").cast("timestamp")))
            .alias("event_ms"),
            "event",
        )
    )
    changes = dated.groupBy("month", "share").applyInPandasWithState(
        _count, _CHANGES, _SUMS, "update", GroupStateTimeout.NoTimeout
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(
            f"{totals}/batch-{batch_id:012d}"
        )

    return (
        changes.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .queryName("sales_totals")
        .trigger(availableNow=True)
        .start()
    )


def _changes(spark: SparkSession, totals: str) -> DataFrame:
    schema = f"{_CHANGES}, batch_id long"
    if not folder_exists(spark, totals):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(totals)


def monthly_totals(spark: SparkSession, totals: str) -> DataFrame:
    """Orders, units and revenue of every month, without the late ones: the sums last written."""
    latest = _changes(spark, totals).filter("orders IS NOT NULL").groupBy("month", "share")
    latest = latest.agg(F.max(F.struct("batch_id", "orders", "tenths", "mils")).alias("now"))
    return latest.groupBy("month").agg(
        F.sum("now.orders").alias("total_orders"),
        (F.sum("now.tenths").cast("decimal(38,1)") / 10).cast(UNITS).alias("total_units_sold"),
        (F.sum("now.mils").cast("decimal(34,0)") * F.lit("0.001").cast("decimal(3,3)")).cast(REVENUE).alias("total_revenue"),
    )


def late_sales(spark: SparkSession, totals: str) -> DataFrame:
    """Sales that came after the watermark had passed their date, one row each."""
    late = _changes(spark, totals).filter("orders IS NULL")
    return late.select(
        F.col("late_order").alias("order_id"),
        F.col("late_date").alias("order_date"),
        (F.col("late_tenths").cast("decimal(38,1)") / 10).cast(UNITS).alias("units"),
        (F.col("late_mils").cast("decimal(34,0)") * F.lit("0.001").cast("decimal(3,3)")).cast(REVENUE).alias("revenue"),
    )
