"""CSV reading, the landing stream and the catalog build."""

from __future__ import annotations

import itertools
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from fixtures import rows_of
from pyspark.errors import PySparkException

from tallyloom.model import SOURCES, Schemas
from tallyloom.plans import extracts, warehouse
from tallyloom.session import scratch_folder
from tallyloom.sources.csv_files import (
    FileDrop,
    accepted,
    list_files,
    read_delivered,
    rejected,
    rows_by_file,
    tables_from_csv,
)
from tallyloom.streaming import landing

CLIENTS = "client__2024_15_06_09_00.csv"


def deliver(folder, name, lines, header="any,header", end="\r\n", last_end=True):
    file = Path(folder) / name
    file.parent.mkdir(parents=True, exist_ok=True)
    text = end.join([header, *lines]) + (end if last_end else "")
    file.write_text(text, newline="")


def orders_in(spark, folder):
    rows = read_delivered(spark, FileDrop(str(folder)), "orders")
    return accepted(rows, "orders"), rejected(rows)


def test_rows_are_typed_by_position(spark, tmp_path):
    deliver(tmp_path / "orders", "orders__1.csv", ["1,2,3,2024-06-01,Pending,30.00"])
    good, _ = orders_in(spark, tmp_path)
    assert good.schema == SOURCES["orders"]
    assert rows_of(good) == [(1, 2, 3, date(2024, 6, 1), "Pending", Decimal("30.00"))]


def test_ids_may_exceed_32_bits(spark, tmp_path):
    deliver(tmp_path / "client_type", "client_type__1.csv", ["3000000000,Standard"])
    rows = read_delivered(spark, FileDrop(str(tmp_path)), "client_type")
    assert rows_of(accepted(rows, "client_type")) == [(3_000_000_000, "Standard")]


def test_date_only_text_becomes_a_timestamp(spark, tmp_path):
    lines = ["1,Ada,ada@mail.example,(555) 000-0001,12 Sample St,1,1,2020-05-10"]
    deliver(tmp_path / "client", CLIENTS, lines, last_end=False)
    rows = accepted(read_delivered(spark, FileDrop(str(tmp_path)), "client"), "client")
    assert rows.first().registration_date == datetime(2020, 5, 10)


def test_null_texts(spark, tmp_path):
    lines = [
        "1,NULL,,2024-06-01,NULL,",
        '2,"",1,2024-06-01,"",NULL',
        "3,1,1,2024-06-01,null,1.00",
        "4,1,1,2024-06-01, ,1.00",
    ]
    deliver(tmp_path / "orders", "orders__1.csv", lines)
    good, bad = orders_in(spark, tmp_path)
    day = date(2024, 6, 1)
    assert rows_of(good) == [
        (1, None, None, day, None, None),
        (2, None, 1, day, None, None),
        (3, 1, 1, day, "null", Decimal("1.00")),
        (4, 1, 1, day, " ", Decimal("1.00")),
    ]
    assert bad.count() == 0


BAD = [
    "2,1,1,notadate,Pending,1.00",
    "x,1,1,2024-06-01,Pending,1.00",
    "3,1,1",
    "4,1,1,2024-06-01,Pending,1.00,surplus",
    "5,1,1,2024-06-01,Pending,99999999999.00",
    "6,1,1.5,2024-06-01,Pending,1.00",
    "7,1,1,2024-06-01 junk,Pending,1.00",
    "8,1,1,2024,Pending,1.00",
    "9,1,1,2024-6-1,Pending,1.00",
    "10,1,1,2024-06-01,Pending,15.005",
    "11,1,1,2024-06-01,Pending,1e2",
    "12x,1,1,2024-06-01,Pending,1.00",
]


def test_bad_rows_are_set_aside_with_their_text(spark, tmp_path):
    deliver(tmp_path / "orders", "orders__1.csv", ["1,1,1,2024-06-01,Pending,1.00", *BAD])
    good, bad = orders_in(spark, tmp_path)
    assert [row.order_id for row in good.collect()] == [1]
    assert sorted(row.record for row in bad.collect()) == sorted(BAD)


@pytest.mark.parametrize("columns", [["order_id"], ["status"], ["order_date", "status"], []])
def test_acceptance_does_not_depend_on_the_columns_read(spark, tmp_path, columns):
    deliver(tmp_path / "orders", "orders__1.csv", ["1,1,1,2024-06-01,Pending,1.00", *BAD])
    good, bad = orders_in(spark, tmp_path)
    assert good.select(*columns).count() == 1
    assert len(good.select(*columns).collect()) == 1
    assert bad.count() == len(BAD)


def test_whole_cells_are_converted_or_rejected(spark, tmp_path):
    lines = [
        "1,1,1,2.0,15.00", "2,1,1,2.06,15.00", "3,1,1,2.60,15", "4,1,1,-.5,+1.500", "5,1,1, 3 ,1.",
        "6,1,1,.,1", "7,1,1,1,1.001",
    ]
    deliver(tmp_path / "order_product", "order_product__1.csv", lines)
    rows = read_delivered(spark, FileDrop(str(tmp_path)), "order_product")
    good = rows_of(accepted(rows, "order_product"), "order_product_id", "quantity", "price_unit")
    d = Decimal
    assert good == [
        (1, d("2.0"), d("15.00")), (3, d("2.6"), d("15.00")), (4, d("-0.5"), d("1.50")), (5, d("3.0"), d("1.00")),
    ]
    assert sorted(row.record[0] for row in rejected(rows).collect()) == ["2", "6", "7"]


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("2020-05-10", datetime(2020, 5, 10)),
        ("2020-05-10 07:08", datetime(2020, 5, 10, 7, 8)),
        ("2020-05-10T07:08:09.5", datetime(2020, 5, 10, 7, 8, 9, 500_000)),
        ("2020-05-10 noon", None),
        ("2020", None),
        ("2020-05-10 25:00", None),
    ],
)
def test_timestamps(spark, tmp_path, text, value):
    lines = [f"1,Ada,ada@mail.example,(555) 000-0001,12 Sample St,1,1,{text}"]
    deliver(tmp_path / "client", CLIENTS, lines)
    rows = accepted(read_delivered(spark, FileDrop(str(tmp_path)), "client"), "client")
    assert [row.registration_date for row in rows.collect()] == ([value] if value else [])


def test_a_rejected_record_reads_back_into_its_cells(spark, tmp_path):
    cells = ['"Lovelace, Ada"', "a@b", '" 1,2 "', "NULL", "1", "x", "2020-05-10"]
    deliver(tmp_path / "first" / "client", CLIENTS, [",".join(["1", *cells])])
    bad = rejected(read_delivered(spark, FileDrop(f"{tmp_path}/first"), "client"))
    (record,) = [row.record for row in bad.collect()]
    repaired = record.replace(",x,", ",2,")
    deliver(tmp_path / "second" / "client", CLIENTS, [repaired])
    rows = accepted(read_delivered(spark, FileDrop(f"{tmp_path}/second"), "client"), "client")
    assert rows_of(rows) == [
        (1, "Lovelace, Ada", "a@b", " 1,2 ", None, 1, 2, datetime(2020, 5, 10))
    ]


def test_rows_by_file(spark, tmp_path):
    deliver(tmp_path / "orders" / "first", "orders__1.csv", [an_order(1), BAD[0]])
    deliver(tmp_path / "orders" / "second", "orders__2.csv", [an_order(2)])
    found = rows_by_file(spark, FileDrop(str(tmp_path)), "orders").collect()
    assert sorted((Path(r.file_path).name, r.rows, r.rejected_rows) for r in found) == [
        ("orders__1.csv", 2, 1), ("orders__2.csv", 1, 0),
    ]
    assert all(r.file_size > 0 and r.file_time for r in found)


def test_names_in_one_flat_folder(spark, tmp_path):
    deliver(tmp_path, "product__1.csv", ["1,Mouse,Electronics,15.00"])
    deliver(tmp_path, "order_product__1.csv", ["7,1,1,2.0,15.00"])
    deliver(tmp_path, "client__1.csv", ["1,Ada,a@b,1,2,1,1,2020-05-10"])
    deliver(tmp_path, "client_type__1.csv", ["1,Standard"])
    deliver(tmp_path, "client_status__1.csv", ["1,Active"])
    deliver(tmp_path, "orders__1.csv", ["1,1,1,2024-06-01,Pending,30.00"])
    deliver(tmp_path, "payment_method__1.csv", ["1,card"])
    tables = tables_from_csv(spark, FileDrop(str(tmp_path), by_table=False))
    assert {name: rows.count() for name, rows in tables.items()} == dict.fromkeys(SOURCES, 1)
    assert tables["product"].first().product_name == "Mouse"


def test_files_with_other_names_are_ignored(spark, tmp_path):
    deliver(tmp_path / "orders", "orders__1.csv", ["1,1,1,2024-06-01,Pending,1.00"])
    deliver(tmp_path / "orders" / "2024", "orders__2.csv", ["2,1,1,2024-06-01,Pending,1.00"])
    deliver(tmp_path / "orders", "readme.csv", ["3,1,1,2024-06-01,Pending,1.00"])
    good, _ = orders_in(spark, tmp_path)
    assert rows_of(good, "order_id") == [(1,), (2,)]


def test_file_listing(spark, tmp_path):
    deliver(tmp_path / "orders", "orders__1.csv", ["1"])
    deliver(tmp_path / "client", CLIENTS, ["1"])
    listed = list_files(spark, str(tmp_path), "*__*.csv").collect()
    assert sorted(Path(row.path).name for row in listed) == [CLIENTS, "orders__1.csv"]
    assert all(row.size > 0 and row.modified for row in listed)


def test_scratch_folder_follows_the_session(spark):
    first, second = scratch_folder(spark, "a"), scratch_folder(spark, "a")
    assert first.startswith(spark.conf.get("spark.checkpoint.dir")) and first != second


class Landing:
    def __init__(self, spark, folder):
        self.spark, self.base = spark, str(folder)
        self.drop = FileDrop(f"{folder}/delivered")

    def run(self, tables=("orders",), **options):
        landing.land(
            self.spark, self.drop, f"{self.base}/landed", f"{self.base}/checks", tables, **options
        )

    def status(self, tables=("orders",)):
        """(table, batch, file, rows, rejects) in order."""
        rows = landing.landing_status(self.spark, f"{self.base}/landed", tables).collect()
        return sorted(
            (r.table_name, r.batch_id, Path(r.source_file).name, r.input_rows, r.rejected_rows)
            for r in rows
        )

    def deliver(self, table, name, lines):
        deliver(self.drop.folder(table), name, lines)

    def ids(self):
        rows = landing.landed_rows(self.spark, f"{self.base}/landed", "orders")
        return sorted(row.order_id for row in rows.collect())


def an_order(number):
    return f"{number},1,1,2024-06-01,Pending,1.00"


def test_each_file_is_loaded_once(spark, tmp_path):
    shop = Landing(spark, tmp_path)
    shop.deliver("orders", "orders__1.csv", [an_order(1), an_order(2)])
    shop.run()
    assert shop.status() == [("orders", 0, "orders__1.csv", 2, 0)]
    assert shop.ids() == [1, 2]
    shop.run()
    assert len(shop.status()) == 1
    assert shop.ids() == [1, 2]
    shop.deliver("orders", "orders__2.csv", [an_order(3)])
    shop.deliver("orders", "other.csv", [an_order(9)])
    shop.run()
    assert shop.ids() == [1, 2, 3]
    shop.deliver("orders", "orders__3.csv", [an_order(3)])
    shop.run()
    assert shop.ids() == [1, 2, 3, 3]


def test_tables_without_a_delivery_are_empty(spark, tmp_path):
    shop = Landing(spark, tmp_path)
    shop.deliver("orders", "orders__1.csv", [an_order(1)])
    shop.run(tables=SOURCES)
    assert [row[0] for row in shop.status(SOURCES)] == ["orders"]
    for table in SOURCES:
        rows = landing.landed_rows(spark, f"{tmp_path}/landed", table)
        assert rows.schema == SOURCES[table]
        assert rows.count() == (table == "orders")
    batch = tables_from_csv(spark, shop.drop)
    assert {name for name, rows in batch.items() if rows.count()} == {"orders"}


def test_folder_with_only_foreign_files_is_empty(spark, tmp_path):
    shop = Landing(spark, tmp_path)
    shop.deliver("product", "order_product__1.csv", ["7,1,1,2.0,15.00"])
    shop.run(tables=["product"])
    assert shop.status(["product"]) == []
    assert landing.landed_rows(spark, f"{tmp_path}/landed", "product").count() == 0
    assert read_delivered(spark, shop.drop, "product").count() == 0


def test_backlog_is_committed_in_steps(spark, tmp_path):
    shop = Landing(spark, tmp_path)
    for number in range(5):
        shop.deliver("orders", f"orders__{number}.csv", [an_order(number)])
    shop.run(files_per_batch=2)
    assert [row[1] for row in shop.status()] == [0, 0, 1, 1, 2]
    assert shop.ids() == [0, 1, 2, 3, 4]


def test_status_is_complete_for_a_long_backlog(spark, tmp_path):
    """More micro-batches than Spark remembers the progress of."""
    shop = Landing(spark, tmp_path)
    for number in range(120):
        shop.deliver("orders", f"orders__{number:03d}.csv", [an_order(number)])
    shop.run(files_per_batch=1)
    status = shop.status()
    assert len(status) == 120 and {row[1] for row in status} == set(range(120))
    assert sum(row[3] for row in status) == 120


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    shop = Landing(spark, tmp_path)
    for number in range(3):
        shop.deliver("orders", f"orders__{number}.csv", [an_order(number)])
    shop.run(files_per_batch=1)
    before = shop.status()
    # As if the driver had died after writing the last batch and before noting it.
    commits = Path(f"{tmp_path}/checks/orders/commits")
    for name in ("2", ".2.crc"):
        (commits / name).unlink()
    # A part that a first attempt left is replaced with the rest.
    left = Path(f"{tmp_path}/landed/orders/batch-000000000002")
    part = next(left.glob("part-*.parquet"))
    (left / "part-from-the-first-attempt.parquet").write_bytes(part.read_bytes())
    shop.run()
    assert shop.status() == before
    assert shop.ids() == [0, 1, 2]


def test_a_lost_checkpoint_is_noticed(spark, tmp_path):
    shop = Landing(spark, tmp_path)
    shop.deliver("orders", "orders__1.csv", [an_order(1)])
    shop.run()
    with pytest.raises(ValueError, match="checkpoint"):
        landing.land(spark, shop.drop, f"{tmp_path}/landed", f"{tmp_path}/other", ["orders"])
    assert shop.ids() == [1]


def test_one_failing_table_does_not_stop_the_others(spark, tmp_path, monkeypatch):
    shop = Landing(spark, tmp_path)
    shop.deliver("orders", "orders__1.csv", [an_order(1)])
    shop.deliver("product", "product__1.csv", ["1,Mouse,Electronics,15.00"])
    usual = landing._write_batch

    def writes(folder):
        if folder.endswith("/orders"):
            def fail(batch, batch_id):
                raise OSError("no space")
            return fail
        return usual(folder)

    monkeypatch.setattr(landing, "_write_batch", writes)
    with pytest.raises(landing.LandingFailed, match="land_orders"):
        shop.run(tables=["orders", "product"])
    assert landing.landed_rows(spark, f"{tmp_path}/landed", "product").count() == 1
    monkeypatch.undo()
    shop.run()
    assert shop.ids() == [1]


def test_missing_dates_are_kept_by_both_deliveries(spark, tmp_path):
    shop = Landing(spark, tmp_path)
    shop.deliver("orders", "orders__1.csv", ["1,1,1,NULL,NULL,1.00", "NULL,1,1,,Pending,NULL"])
    shop.run()
    rows = landing.landed_rows(spark, f"{tmp_path}/landed", "orders")
    assert rows.count() == 2 and rows.filter("order_date is null").count() == 2


def test_late_files_are_not_dropped(spark, tmp_path):
    import os

    shop = Landing(spark, tmp_path)
    shop.deliver("orders", "orders__1.csv", [an_order(1)])
    shop.run()
    shop.deliver("orders", "orders__2.csv", [an_order(2)])
    old = datetime(2020, 1, 1).timestamp()
    os.utime(Path(shop.drop.folder("orders")) / "orders__2.csv", (old, old))
    shop.run()
    assert shop.ids() == [1, 2]


def test_stream_sets_bad_rows_aside(spark, tmp_path):
    shop = Landing(spark, tmp_path)
    shop.deliver("orders", "orders__1.csv", [an_order(1), *BAD])
    shop.run()
    assert shop.ids() == [1]
    bad = landing.landed_rejects(spark, f"{tmp_path}/landed", "orders")
    assert sorted(row.record for row in bad.collect()) == sorted(BAD)


@pytest.fixture
def fresh_catalog(spark):
    yield
    for schema in ("oltp", "hand_on", "hand_on_output", "work"):
        spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


DELIVERY = {
    "client": ["1,Ada,ada@mail.example,(555) 000-0001,12 Sample St,1,1,2020-05-10"],
    "client_status": ["1,Active"],
    "client_type": ["1,Standard"],
    "orders": ["1,1,1,2024-06-01,Pending,30.00"],
    "order_product": ["1,1,1,2.0,15.00", "bad,1,1,2.0,15.00"],
    "product": ["1,Mouse,Electronics,15.00"],
    "payment_method": ["1,card"],
}


def test_warehouse_from_files_to_extracts(spark, tmp_path, fresh_catalog):
    shop = Landing(spark, tmp_path)
    for table, lines in DELIVERY.items():
        shop.deliver(table, f"{table}__1.csv", lines)
    landing.create_raw_tables(spark, f"{tmp_path}/landed")
    # The raw tables can be counted before any layer is built.
    assert {row.row_count for row in warehouse.audit_raw(spark).collect()} == {0}

    warehouse.build(spark)
    raw, star = warehouse.audit(spark)
    assert {row.row_count for row in raw.collect()} == {0}
    assert {row.row_count for row in star.collect()} == {0}

    shop.run(tables=SOURCES)
    raw_rows = {name: rows.count() for name, rows in landing.raw_tables(spark).items()}
    assert raw_rows == dict.fromkeys(SOURCES, 1)
    assert rows_of(landing.raw_rejects(spark)) == [("order_product", "bad,1,1,2.0,15.00")]

    warehouse.build(spark)
    raw, star = warehouse.audit(spark)
    assert {row.row_count for row in raw.collect()} == {1}
    assert {row.row_count for row in star.collect()} == {1}
    assert rows_of(warehouse.gold_table(spark, "mart_monthly_sales")) == [
        (date(2024, 6, 1), 1, Decimal("2.0"), Decimal("30.000"), Decimal("30.00"))
    ]
    masked = spark.sql("select email from hand_on_output.dim_client")
    assert masked.first().email == "a***@mail.example"
    clear = spark.sql("select email from hand_on.stg_client")
    assert clear.first().email == "ada@mail.example"
    assert warehouse.gold_table(spark, "mart_cube_category_month").count() == 4
    assert warehouse.gold_table(spark, "mart_cube_payment_status").count() == 4
    commented = spark.table("hand_on_output.fact_orders").schema["client_id"].metadata["comment"]
    assert commented == "Foreign key to dim_client.client_id"
    assert spark.table("hand_on.stg_orders").schema["order_id"].metadata["comment"] == "Primary key"
    totals = extracts.kpi_totals(warehouse.stored_order_sales(spark))
    assert rows_of(totals) == [(1, 1, Decimal("2.0"), Decimal("30.000"))]
    report = warehouse.check(spark).collect()
    assert len(report) == 28 and all(row.passed for row in report)

    # A late delivery: staging sees it at once, the gold tables after the next build.
    shop.deliver("orders", "orders__2.csv", ["2,7,1,2024-07-01,Shipped,15.00"])
    shop.deliver("order_product", "order_product__2.csv", ["2,2,1,1.0,15.00"])
    shop.run(tables=SOURCES)
    assert spark.table("hand_on.stg_orders").count() == 2
    assert warehouse.gold_table(spark, "fact_orders").count() == 1
    warehouse.build(spark, layers=["gold"])
    assert warehouse.gold_table(spark, "fact_orders").count() == 2
    assert warehouse.gold_table(spark, "mart_monthly_sales").count() == 2
    assert warehouse.gold_table(spark, "mart_sales_by_client").count() == 1
    failed = warehouse.check(spark).filter("not passed")
    assert rows_of(failed, "column_name", "check_name", "failures") == [
        ("client_id", "relationships", 1)
    ]


def load_delivery(spark, folder):
    shop = Landing(spark, folder)
    for table, lines in DELIVERY.items():
        shop.deliver(table, f"{table}__1.csv", lines)
    landing.create_raw_tables(spark, f"{folder}/landed")
    shop.run(tables=SOURCES)
    return shop


def gold_folder(spark, name):
    uri = spark.catalog.getDatabase("hand_on_output").locationUri
    return Path(uri.removeprefix("file:")) / name


def test_failed_build_keeps_the_old_tables(spark, tmp_path, fresh_catalog):
    shop = load_delivery(spark, tmp_path)
    warehouse.build(spark)
    month = "mart_monthly_sales"
    before = rows_of(warehouse.gold_table(spark, month))
    # A line without units makes the average price of its category a division by zero.
    shop.deliver("order_product", "order_product__2.csv", ["2,1,2,0.0,15.00"])
    shop.deliver("product", "product__2.csv", ["2,Book,Books,15.00"])
    shop.run(tables=SOURCES)
    with pytest.raises(PySparkException, match="DIVIDE_BY_ZERO"):
        warehouse.build(spark)
    assert warehouse.gold_table(spark, "mart_sales_by_category").count() == 1
    assert rows_of(warehouse.gold_table(spark, month)) == before

    shop.deliver("order_product", "order_product__3.csv", ["3,1,2,1.0,15.00"])
    shop.run(tables=SOURCES)
    warehouse.build(spark)
    assert warehouse.gold_table(spark, "mart_sales_by_category").count() == 2


def test_build_overwrites_what_a_killed_build_left(spark, tmp_path, fresh_catalog):
    load_delivery(spark, tmp_path)
    warehouse.build(spark, layers=["silver"])
    spark.sql("CREATE SCHEMA hand_on_output")
    spark.sql("CREATE SCHEMA work")
    uri = spark.catalog.getDatabase("work").locationUri
    for folder in (
        gold_folder(spark, "fact_orders") / "a",
        Path(uri.removeprefix("file:")) / "order_sales",
    ):
        folder.mkdir(parents=True)
        (folder / "part-00000.parquet").write_text("half a file")
    for _ in range(3):
        warehouse.build(spark)
        assert warehouse.gold_table(spark, "fact_orders").count() == 1
    slots = sorted(folder.name for folder in gold_folder(spark, "fact_orders").iterdir())
    assert slots == ["a", "b"]


def test_gold_table_follows_a_changed_schema(spark, tmp_path, fresh_catalog):
    load_delivery(spark, tmp_path)
    warehouse.build(spark)
    old = warehouse.gold_table(spark, "dim_payment")
    warehouse.store("dim_payment", old.withColumn("note", old.payment_method))
    assert warehouse.gold_table(spark, "dim_payment").columns[-1] == "note"


def test_silver_layer_alone(spark, tmp_path, fresh_catalog):
    landing.create_raw_tables(spark, f"{tmp_path}/landed")
    landing.create_raw_tables(spark, f"{tmp_path}/landed")
    warehouse.build(spark, layers=["silver"])
    views = {row.viewName for row in spark.sql("show views in hand_on").collect()}
    assert views == {f"stg_{name}" for name in SOURCES}
    assert not spark.catalog.databaseExists("hand_on_output")
    comment = spark.sql("describe extended hand_on.stg_orders").filter("col_name = 'Comment'")
    assert comment.first().data_type


def test_two_warehouses_side_by_side(spark, tmp_path, fresh_catalog):
    load_delivery(spark, tmp_path)
    other = Schemas.prefixed("second")
    try:
        landing.create_raw_tables(spark, f"{tmp_path}/landed", other)
        warehouse.build(spark, schemas=other)
        assert not spark.catalog.databaseExists("hand_on_output")
        assert warehouse.gold_table(spark, "fact_orders", other).count() == 1
        assert warehouse.audit_star(spark, other).agg({"row_count": "sum"}).first()[0] == 4
        assert warehouse.check(spark, other).filter("not passed").isEmpty()
    finally:
        for name in (other.raw, other.silver, other.gold, other.work):
            spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


def test_unknown_layer_is_refused(spark):
    with pytest.raises(ValueError, match="bronze"):
        warehouse.build(spark, layers=["bronze"])


def test_every_relation_is_described():
    from tallyloom.model import DESCRIPTIONS, PRIMARY_KEYS

    assert set(PRIMARY_KEYS) <= set(DESCRIPTIONS)
    assert len(set(itertools.chain(DESCRIPTIONS.values()))) == len(DESCRIPTIONS)
