"""Data-quality checks. A check selects offending rows; none means it passed."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.measures import REVENUE, line_revenue
from tallyloom.model import FACT, FOREIGN_KEYS, PRIMARY_KEYS, ForeignKey


def order_total_mismatches(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders whose recorded total is not the sum of their lines, with both sums.

    Lines are added up before the join, so it sees one row an order and side. An order without
    lines, or without a total, is listed with NULL for what is missing; so is one whose
    lines have no order. Orders that occur more than once are each compared. Lines and orders
    without an id are left to the not-null checks.
    """
    sums = (
        lines.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.count("*").alias("line_count"), F.sum(line_revenue()).cast(REVENUE).alias("line_total"))
    )
    recorded = orders.filter(F.col("order_id").isNotNull()).select("order_id", "total_amount")
    both = recorded.join(sums, "order_id", "full")
    total = F.col("total_amount").cast(REVENUE)
    return both.filter(~total.eqNullSafe(F.col("line_total"))).select(
        "order_id",
        "total_amount",
        "line_total",
        (total - F.col("line_total")).cast(REVENUE).alias("difference"),
        F.coalesce("line_count", F.lit(0)).alias("line_count"),
    )


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Key values that occur more than once. Two NULL keys count as a duplicate, too."""
    return df.groupBy(F.col(column).alias("key")).agg(F.count("*").alias("occurrences")).filter(
        F.col("occurrences") > 1
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a value, per column; all columns in one scan, without a row shuffle."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_rows")


def foreign_key_values(child: DataFrame, keys: Sequence[ForeignKey]) -> DataFrame:
    """Distinct values of all foreign keys with their row counts, from one pass over the child."""
    columns = [key.column for key in keys]
    values = child.select(*[F.col(c).cast("bigint").alias(c) for c in columns])
    return (
        values.unpivot([], columns, "column_name", "key")
        .groupBy("column_name", "key")
        .agg(F.count("*").alias("row_count"))
    )


def parent_values(parents: dict[str, DataFrame], keys: Sequence[ForeignKey]) -> DataFrame:
    """Key values of all parents, labelled by the foreign key that refers to them."""
    labelled = [
        parents[key.parent].select(
            F.lit(key.column).alias("column_name"),
            F.col(key.parent_column).cast("bigint").alias("key"),
        )
        for key in keys
    ]
    return reduce(DataFrame.unionByName, labelled)


def orphan_keys(
    child: DataFrame, parents: dict[str, DataFrame], keys: Sequence[ForeignKey] = FOREIGN_KEYS
) -> DataFrame:
    """Foreign-key values that no parent row has. NULL is left to the not-null check.

    Equal keys are counted before the anti join, so a key shared by very many rows
    reaches it as a single row.
    """
    values = foreign_key_values(child, keys).filter(F.col("key").isNotNull())
    return values.join(parent_values(parents, keys), ["column_name", "key"], "left_anti")


def unique_failures(models: dict[str, DataFrame]) -> DataFrame:
    """Every duplicated primary key of every tested relation."""
    found = [
        duplicate_keys(models[model], column).select(
            F.lit(model).alias("model"), F.lit(column).alias("column_name"), "key", "occurrences"
        )
        for model, column in PRIMARY_KEYS.items()
    ]
    return reduce(DataFrame.unionByName, found)


def not_null_report(models: dict[str, DataFrame]) -> DataFrame:
    """Null counts of all primary keys and of the fact's foreign keys, one scan per relation."""
    reports = []
    for model, column in PRIMARY_KEYS.items():
        columns = [column]
        if model == FACT:
            columns += [key.column for key in FOREIGN_KEYS]
        counts = null_counts(models[model], columns)
        reports.append(counts.select(F.lit(model).alias("model"), "column_name", "null_rows"))
    return reduce(DataFrame.unionByName, reports)


def relationship_report(models: dict[str, DataFrame]) -> DataFrame:
    """Fact rows that refer to a missing dimension row, per foreign key."""
    found = orphan_keys(models[FACT], models).select("column_name", "row_count")
    # Every key is listed, also one without orphans.
    listed = found.sparkSession.sql(_values((key.column, 0) for key in FOREIGN_KEYS))
    return (
        found.union(listed)
        .groupBy("column_name")
        .agg(F.sum("row_count").alias("orphan_rows"))
        .select(F.lit(FACT).alias("model"), "column_name", "orphan_rows")
    )


def _values(rows: Iterable[tuple]) -> str:
    """A few declared names and numbers as an inline table."""
    text = ", ".join(str(row).replace("None", "CAST(NULL AS BIGINT)") for row in rows)
    return f"VALUES {text}"


# Which count per relation decides which declared check: a relation's own key must be
# unique and complete, and the fact's references to it complete and known.
_DECLARED = [
    row
    for model, column in PRIMARY_KEYS.items()
    for row in (
        (model, "repeated", model, column, "unique"),
        (model, "missing", model, column, "not_null"),
    )
] + [
    row
    for key in FOREIGN_KEYS
    for row in (
        (key.parent, "missing_references", FACT, key.column, "not_null"),
        (key.parent, "unknown_references", FACT, key.column, "relationships"),
    )
]


def _key_values(models: dict[str, DataFrame]) -> DataFrame:
    """All key values by relation: the relation's own, and those by which the fact refers to it."""
    parts = [
        models[model].select(F.lit(model).alias("relation"), F.col(column).alias("key"))
        for model, column in PRIMARY_KEYS.items()
        if model != FACT
    ]
    own = reduce(DataFrame.unionByName, parts).withColumn("is_own", F.lit(1))
    # The fact's own key and its references in one pass.
    columns = {FACT: PRIMARY_KEYS[FACT]} | {key.parent: key.column for key in FOREIGN_KEYS}
    fact = models[FACT].select(*[F.col(c).alias(relation) for relation, c in columns.items()])
    fact = fact.unpivot([], list(columns), "relation", "key")
    return own.unionByName(fact.withColumn("is_own", (F.col("relation") == FACT).cast("int")))


def quality_report(models: dict[str, DataFrame]) -> DataFrame:
    """All declared checks, one row each, with the number of failures.

    One aggregate serves them all: the keys of all relations, and the fact's references
    to them, are counted by value. Equal keys meet on the map side first, so a key on very
    many rows does no harm.
    """
    values = (
        _key_values(models)
        .groupBy("relation", "key")
        .agg(
            F.count_if(F.col("is_own") == 1).alias("own"),
            F.count_if(F.col("is_own") == 0).alias("referring"),
        )
    )
    # A relation without rows takes part, too.
    listed = values.sparkSession.sql(_values((model, None, 0, 0) for model in PRIMARY_KEYS))
    known = F.col("key").isNotNull()
    own, referring = F.col("own"), F.col("referring")
    counts = (
        values.union(listed)
        .groupBy("relation")
        .agg(
            F.count_if(own > 1).alias("repeated"),
            F.sum(F.when(known, 0).otherwise(own)).alias("missing"),
            F.sum(F.when(known, 0).otherwise(referring)).alias("missing_references"),
            F.sum(F.when(known & (own == 0), referring).otherwise(0)).alias("unknown_references"),
        )
    )
    names = ["repeated", "missing", "missing_references", "unknown_references"]
    failures = counts.unpivot(["relation"], names, "measure", "failures")
    declared = failures.sparkSession.sql(_values(_DECLARED)).toDF(
        "relation", "measure", "model", "column_name", "check_name"
    )
    return failures.join(declared, ["relation", "measure"]).select(
        "model", "column_name", "check_name", "failures", (F.col("failures") == 0).alias("passed")
    )
