"""Totals under a watermark, rows that arrive twice, and distinct counts that add up."""

from __future__ import annotations

import random
import time
from datetime import date, timedelta
from decimal import Decimal

import pytest
from fixtures import order, rows_of
from pyspark.sql import functions as F

from tallyloom.operators import sketches
from tallyloom.sources.csv_files import FileDrop
from tallyloom.streaming import landing, totals


class Arrivals:
    """Deliveries of sales and the totals after each, beside the same by hand."""

    def __init__(self, spark, folder, lateness=10):
        self.spark, self.base, self.lateness = spark, str(folder), lateness
        self.latest: date | None = None
        self.on_time, self.late = [], []

    def send(self, rows):
        self.spark.createDataFrame(rows, totals.SALES).repartition(3).write.mode("append").parquet(f"{self.base}/sales")
        bound = self.latest and self.latest - timedelta(days=self.lateness)
        for row in rows:
            behind = row[1] is None or (bound is not None and row[1] < bound)
            (self.late if behind else self.on_time).append(row)
        self.latest = max([r[1] for r in rows if r[1]] + [self.latest or date.min])
        self.run()

    def run(self):
        totals.start_totals(
            self.spark, f"{self.base}/sales", f"{self.base}/totals", f"{self.base}/cp", f"{self.lateness} days"
        ).awaitTermination()

    def expected(self):
        by_month: dict = {}
        for _, day, units, revenue in self.on_time:
            sums = by_month.setdefault(day.replace(day=1), [0, Decimal(0), Decimal(0)])
            sums[0] += 1
            sums[1] += units or 0
            sums[2] += revenue or 0
        return [(m, n, u, r) for m, (n, u, r) in sorted(by_month.items())]

    def check(self):
        found = totals.monthly_totals(self.spark, f"{self.base}/totals")
        assert rows_of(found) == self.expected()
        late = totals.late_sales(self.spark, f"{self.base}/totals")
        ids = sorted(row.order_id for row in late.collect())
        assert ids == sorted(row[0] for row in self.late)


def sales(rng, ids, first, days):
    return [
        (i, date(2024, 1, 1) + timedelta(days=first + rng.randrange(days)), Decimal(rng.randrange(1, 90)) / 10, Decimal(rng.randrange(10**9)) / 1000)
        for i in ids
    ]


def test_totals_and_late_sales_are_all_that_arrived(spark, tmp_path):
    rng = random.Random(2)
    arrivals = Arrivals(spark, tmp_path)
    arrivals.send(sales(rng, range(200), 0, 40))
    arrivals.check()
    assert not arrivals.late
    # Late by the first delivery's dates; the new dates of its own delivery do not count yet.
    arrivals.send(sales(rng, range(200, 300), 30, 60) + sales(rng, range(300, 320), 0, 20))
    arrivals.check()
    assert 0 < len(arrivals.late) <= 20
    arrivals.run()  # nothing new
    arrivals.check()
    arrivals.send(sales(rng, range(320, 340), 0, 100) + [(400, None, Decimal("1.0"), Decimal("1.000")), (401, date(2024, 4, 9), None, None)])
    arrivals.check()
    assert len(arrivals.on_time) + len(arrivals.late) == 342
    revenue = totals.late_sales(spark, f"{tmp_path}/totals").agg(F.sum("revenue")).first()[0]
    assert revenue == sum(r[3] for r in arrivals.late)


def test_no_totals_before_the_first_sale(spark, tmp_path):
    assert totals.monthly_totals(spark, f"{tmp_path}/none").collect() == []
    assert totals.late_sales(spark, f"{tmp_path}/none").collect() == []


def test_the_state_of_a_hot_month_is_shared(spark, tmp_path):
    arrivals = Arrivals(spark, tmp_path)
    arrivals.send([(i, date(2024, 3, 1 + i % 31), Decimal("1.0"), Decimal("2.000")) for i in range(3000)])
    arrivals.check()
    shares = totals._changes(spark, f"{tmp_path}/totals").select("share", "orders").distinct().collect()
    assert len(shares) == totals.SHARES and max(s.orders for s in shares) < 200


def put(folder, name, rows):
    (folder / "in" / "orders").mkdir(parents=True, exist_ok=True)
    text = "\n".join(["h", *[",".join("NULL" if v is None else str(v) for v in row) for row in rows]])
    (folder / "in" / "orders" / name).write_text(text + "\n")


def landed_orders(spark, folder, within):
    drop = FileDrop(str(folder / "in"))
    landing.land(spark, drop, f"{folder}/landed", f"{folder}/cp", ["orders"], distinct_within=within)
    return sorted(r.order_id for r in landing.landed_rows(spark, f"{folder}/landed", "orders").collect())


def test_a_file_sent_again_under_a_new_name_adds_no_row_within_the_bound(spark, tmp_path):
    rows = [order(1), order(2), ("x", *order(3)[1:])]
    put(tmp_path, "orders__2024_01_06_00_00.csv", rows)
    assert landed_orders(spark, tmp_path, "1 hour") == [1, 2]
    put(tmp_path, "orders__2024_02_06_00_00.csv", [*rows, order(4), order(1, status="Shipped")])
    assert landed_orders(spark, tmp_path, "1 hour") == [1, 1, 2, 4]
    assert landing.landed_rejects(spark, f"{tmp_path}/landed", "orders").count() == 1
    assert landing.repeated_rows(spark, f"{tmp_path}/landed", "orders").collect() == []


def test_what_is_sent_again_beyond_the_bound_is_reported(spark, tmp_path):
    put(tmp_path, "orders__1.csv", [order(1), order(2)])
    assert landed_orders(spark, tmp_path, "1 second") == [1, 2]
    time.sleep(2)
    put(tmp_path, "orders__2.csv", [order(9)])  # moves the watermark on
    assert landed_orders(spark, tmp_path, "1 second") == [1, 2, 9]
    time.sleep(2)
    put(tmp_path, "orders__3.csv", [order(1)])
    assert landed_orders(spark, tmp_path, "1 second") == [1, 1, 2, 9]
    found = landing.repeated_rows(spark, f"{tmp_path}/landed", "orders")
    assert rows_of(found, "order_id", "times", "files") == [(1, 2, 2)]


@pytest.mark.parametrize("keys", [0, 1, 900, 60_000])
def test_merged_sketches_count_shared_keys_once(spark, keys):
    """Three months, each with two thirds of the keys, and NULL keys beside them."""
    rows = spark.range(3 * keys).select(
        (F.col("id") % 3).alias("month"), F.when(F.col("id") % 11 > 0, F.floor(F.col("id") / 3)).alias("key")
    )
    rows = rows.unionByName(rows).unionByName(spark.range(3).select(F.col("id").alias("month"), F.lit(None).cast("long").alias("key")))
    exact = rows.agg(F.count_distinct("key")).first()[0]
    monthly = sketches.distinct_sketches(rows, ["month"], "key")
    merged = sketches.merged_sketches(monthly, []).select(sketches.estimate(F.col("sketch")).alias("e"))
    estimated = merged.first()["e"]
    assert abs(estimated - exact) <= max(1, sketches.ERROR_BOUND * exact)
    assert merged.select(sketches.within_bound(F.col("e"), F.lit(exact))).first()[0]
    assert monthly.agg(F.max(F.octet_length("sketch"))).first()[0] < 4200
