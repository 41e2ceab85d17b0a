"""Every registered query against its SQL counterpart on DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from __spark_entry__ import entry, oracle_sql, queries

from parity_sql import ORACLE_SQL
from tallyloom import catalog
from tallyloom.plans import warehouse
from tallyloom.sources import benchmark_tables

QUERIES, ORACLE = catalog.QUERIES, ORACLE_SQL


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def comparable(columns, rows):
    """Rows with columns sorted by name, as text, in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple("NULL" if row[i] is None else str(row[i]) for i in order) for row in rows
    )


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    rows = [tuple(row) for row in result.collect()]
    expected = duck.execute(ORACLE[name])
    columns = [column[0] for column in expected.description]
    assert comparable(result.columns, rows) == comparable(columns, expected.fetchall())
    assert rows


def test_every_query_has_its_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("ingest", "warehouse", "heatmap"))))
def test_no_query_runs_a_job_before_it_is_asked_for_rows(spark, sf_dir, name):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"construct-{name}", name)
    try:
        QUERIES[name](spark, sf_dir)
        assert not tracker.getJobIdsForGroup(f"construct-{name}")
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")


def test_flagship_query_runs(spark):
    assert entry(spark).count() > 0


def test_built_tables_equal_the_queries(spark, sf_dir):
    """The catalog build goes from the stored fact to the rollups, the queries from the lines."""
    schemas = ("oltp", "hand_on", "hand_on_output", "work")
    spark.sql("CREATE SCHEMA oltp")
    try:
        for table, rows in benchmark_tables.load(spark, sf_dir).items():
            rows.write.saveAsTable(f"oltp.{table}")
        warehouse.build(spark)
        built = {row.tableName for row in spark.sql("SHOW TABLES IN hand_on_output").collect()}
        assert built == {name for name in QUERIES if name.startswith(("dim_", "fact_", "mart_"))}
        for name in sorted(built):
            stored = warehouse.gold_table(spark, name)
            query = QUERIES[name](spark, sf_dir)
            assert stored.columns == query.columns
            assert sorted(map(str, stored.collect())) == sorted(map(str, query.collect())), name
    finally:
        for schema in schemas:
            spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")
