"""As-of join: every row with what was last known of its key at its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    columns: Sequence[str],
    how: str = "left",
    span: str = "month",
) -> DataFrame:
    """Left rows with the columns of the right row of their key that is latest, but not later
    than they are.

    No pair of a left and a right row is made but the one that counts:

    - Left rows are first reduced, on the map side, to the moments (key, time) at which something
      is asked; a hot key has as many moments as distinct times, not as many as rows.
    - Time is cut into spans (a unit of ``trunc``: ``week``, ``month``, ``year``). A window over
      one row for each key and span finds what each span begins with. Then every span of a key
      is a window of its own, in which the last value seen answers each moment.
    - The answers go back to the rows by an equi-join on (key, time), where adaptive execution
      splits a hot moment.

    Defined cases: a time equal to the right row's finds it; of right rows with equal key and
    time the one with the greatest columns counts; a NULL key or time, on either side, matches
    nothing; with ``how="left"`` rows without a match stay, with NULLs; repeated left rows
    each stay. Times are compared as timestamps without zone.
    """
    moment = F.col("_time")
    begins = F.trunc(moment.cast("date"), span)

    def timed(df: DataFrame, time: str) -> DataFrame:
        df = df.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
        return df.withColumn("_time", F.col(time).cast("timestamp_ntz"))

    known = timed(right, right_time).groupBy(F.col(key).alias("_key"), "_time")
    known = known.agg(F.max(F.struct(*columns)).alias("_found")).withColumn("_span", begins)
    asked = timed(left, left_time).select(F.col(key).alias("_key"), "_time").distinct().withColumn("_span", begins)

    # What each span of a key begins with: the last value of the spans before it.
    ends = known.groupBy("_key", "_span").agg(F.max_by("_found", "_time").alias("_found"))
    nothing = F.lit(None).cast(known.schema["_found"].dataType)
    spans = asked.select("_key", "_span", nothing.alias("_found")).distinct().unionByName(ends)
    spans = spans.groupBy("_key", "_span").agg(F.first("_found", ignorenulls=True).alias("_last"))
    earlier = Window.partitionBy("_key").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select("_key", "_span", F.last("_last", ignorenulls=True).over(earlier).alias("_found"))

    events = (
        known.select("_key", "_span", "_time", F.lit(False).alias("_asked"), "_found")
        .unionByName(
            carried.filter("_found is not null").select(
                "_key", "_span", F.lit(None).cast("timestamp_ntz").alias("_time"), F.lit(False).alias("_asked"), "_found"
            )
        )
        .unionByName(asked.select("_key", "_span", "_time", F.lit(True).alias("_asked"), nothing.alias("_found")))
    )
    # What is known at a moment stands before the question; what was carried over, before all.
    in_span = (
        Window.partitionBy("_key", "_span")
        .orderBy(F.asc_nulls_first("_time"), "_asked")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answers = events.withColumn("_answer", F.last("_found", ignorenulls=True).over(in_span))
    answers = answers.filter("_asked and _answer is not null").select("_key", "_time", "_answer")
    same = (left[key] == answers["_key"]) & (left[left_time].cast("timestamp_ntz") == answers["_time"])
    return left.join(answers, same, how).select(
        *[left[c] for c in left.columns], *[F.col(f"_answer.{c}").alias(c) for c in columns]
    )
