"""Every registered query on the test tables: against SQL, else whole and well formed."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from tallyloom.llm.oracles import ORACLE_SQL
from tallyloom.llm.queries import QUERIES
from tallyloom.llm.tables import table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    result = QUERIES[name](spark, SMALL)
    expected = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in expected.description]
    assert sorted(columns) == sorted(result.columns)
    assert sorted(map(tuple, result.select(columns).collect())) == sorted(expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL) - {"op1_decontamination"}))
def test_query_has_a_row_for_every_row(spark, name):
    source = "pages" if name.startswith("op5_") else "documents"
    result = QUERIES[name](spark, SMALL)
    assert result.count() == table(spark, SMALL, source).count()


def test_all_operators_are_registered():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
