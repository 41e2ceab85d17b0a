"""Distinct counts that add up: one sketch a group, merged for any larger group.

Exact distinct counts of small groups do not give those of larger ones; sketches do, without
going back to the rows. The marts stay exact; these are for questions over many groups.

The estimate's standard error is 1.04 / sqrt(2 ** LOG_SIZE), 1.6 %; three of them,
``ERROR_BOUND``, are exceeded in about one of 400 estimates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_SIZE = 12
ERROR_BOUND = 3 * 1.04 / 2 ** (LOG_SIZE / 2)


def distinct_sketches(rows: DataFrame, group: Sequence[str | Column], key: str, name: str = "sketch") -> DataFrame:
    """A sketch of the distinct keys of every group; at most 4 KB, however many keys.

    NULL keys do not count, and a group of nothing else has an empty sketch. Map tasks
    sketch their own rows, so a hot group is reduced before the shuffle.
    """
    return rows.groupBy(*group).agg(F.hll_sketch_agg(key, F.lit(LOG_SIZE)).alias(name))


def merged_sketches(sketches: DataFrame, group: Sequence[str | Column], name: str = "sketch") -> DataFrame:
    """The sketches of larger groups, which count a key in several of the smaller ones once."""
    return sketches.groupBy(*group).agg(F.hll_union_agg(name).alias(name))


def estimate(sketch: Column) -> Column:
    return F.hll_sketch_estimate(sketch)


def within_bound(estimated: Column, exact: Column) -> Column:
    """Whether an estimate is as near as stated, or less than one off."""
    return F.abs(estimated - exact) <= F.greatest(F.lit(1.0), F.lit(ERROR_BOUND) * exact)
