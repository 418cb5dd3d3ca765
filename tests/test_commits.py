"""Stored tables under failing writes, writers at the same time, reloads and cleaning."""

from __future__ import annotations

import concurrent.futures
import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from qcmart.operators import facts
from qcmart.operators.sketches import hot_slots, slot
from qcmart.plans import loading
from qcmart.plans.job import Job, RunReport
from qcmart.sources import commits, tables
from qcmart.sources.tables import MARTS, QUALITY, RAW, Warehouse
from tests.rawfiles import item, order, write_day, write_full_day, write_references

DAY = dt.date(2024, 3, 15)
NEXT = dt.date(2024, 3, 16)
COUNT = iter(range(1000))
NOW = dt.timedelta(0)


@pytest.fixture
def wh(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"), prefix=f"c{next(COUNT)}_")
    tables.ensure_tables(warehouse)
    return warehouse


@pytest.fixture
def job(spark, tmp_path, wh):
    write_references(tmp_path / "raw")
    return Job(spark, str(tmp_path / "raw"), wh)


def load(job, *days):
    report = RunReport()
    loading.load_days(job, days, report)
    return report


def ids(df):
    return sorted(r.id for r in df.collect())


def test_failing_write_leaves_the_table(spark, wh):
    good = spark.range(100)
    tables.materialize(wh, MARTS, "t", good)
    reader = tables.read_model(wh, MARTS, "t")
    half = spark.range(0, 1000, 1, 8).withColumn(
        "id", F.when(F.col("id") == 990, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("id"))
    )
    for part in (None, F.col("id").cast("string")):
        with pytest.raises(Exception, match="lost"):
            tables.materialize(wh, MARTS, "t", half, part)
    with pytest.raises(Exception, match="lost"):
        tables.replace_reference(wh, "stores", half)
    assert ids(reader) == ids(tables.read_model(wh, MARTS, "t")) == list(range(100))
    assert spark.table(wh.table(MARTS, "t")).count() == 100
    assert tables.read_raw(wh, "stores").count() == 0
    # one who reads the table goes on with what it was
    tables.materialize(wh, MARTS, "t", spark.range(7))
    assert ids(reader) == list(range(100)) and ids(tables.read_model(wh, MARTS, "t")) == list(range(7))
    # a model may be made from the table that it replaces
    again = tables.read_model(wh, MARTS, "t").where("id > 3")
    assert ids(tables.materialize(wh, MARTS, "t", again)) == [4, 5, 6]


def test_runs_at_the_same_time_lose_no_row(spark, wh):
    def results(n):
        return spark.range(n, n + 5).selectExpr(
            "date'2024-03-15' run_date", "'t' table_name", "1L rows_loaded", "concat('c', id) check_name", "'FAIL' status", "'' message"
        )

    with concurrent.futures.ThreadPoolExecutor(6) as pool:
        failed = list(pool.map(lambda n: tables.append_audit(wh, results(10 * n)), range(12)))
    assert failed == [5] * 12
    names = [r.check_name for r in tables.read_audit(wh).collect()]
    assert sorted(names) == sorted(f"c{10 * n + k}" for n in range(12) for k in range(5))
    assert spark.table(wh.table(QUALITY, tables.AUDIT_TABLE)).count() == 60


def test_parts_replaced_at_the_same_time_all_hold(spark, wh):
    def replace(n):
        tables.replace_parts(wh, MARTS, "p", spark.range(n, n + 1), F.col("id").cast("string"), [str(n)])

    tables.materialize(wh, MARTS, "p", spark.range(0), F.col("id").cast("string"))
    with concurrent.futures.ThreadPoolExecutor(4) as pool:
        list(pool.map(replace, range(8)))
    assert ids(tables.read_model(wh, MARTS, "p")) == list(range(8))


def test_days_are_stored_by_the_day_of_their_file(job):
    """Odd dates inside a file cost no folder, and statistics keep scans to the day asked for."""
    odd = [order(200 + k, DAY, date=f"{1000 + k}-01-01") for k in range(40)] + [order(300, DAY, date="?")]
    write_full_day(job.raw_path, DAY)
    write_full_day(job.raw_path, NEXT)
    write_day(job.raw_path, "orders", DAY, [order(i, DAY) for i in range(120)] + odd)
    load(job, DAY, NEXT)
    assert set(job.warehouse.parts(RAW, "raw_orders")) == {str(DAY), str(NEXT)}
    data = pathlib.Path(job.warehouse.location(RAW, "raw_orders"), "data")
    assert len([p for p in data.glob("*/*") if p.is_dir()]) == 2
    orders = tables.read_raw(job.warehouse, "orders")
    assert orders.count() == 281
    found = orders.where(F.col("date") == F.lit(NEXT))
    assert found.count() == 120
    assert "EqualTo(date,2024-03-16)" in found._jdf.queryExecution().executedPlan().toString()
    first = tables.read_raw(job.warehouse, "orders", [str(DAY)])
    assert first.count() == 161 and all(str(DAY) in f for f in first.inputFiles())
    # the file comes again without its odd rows: they go, though their dates are other days
    write_full_day(job.raw_path, DAY)
    load(job, DAY)
    assert {r.date for r in tables.read_raw(job.warehouse, "orders").collect()} == {DAY, NEXT}


def test_sketches_are_kept_by_load_day(job):
    write_full_day(job.raw_path, DAY)
    write_full_day(job.raw_path, NEXT)
    write_day(job.raw_path, "order_items", NEXT, [item(i, NEXT, product_id="P2") for i in range(120)])
    load(job, DAY, NEXT)
    sketches = tables.read_sketches(job.warehouse, "order_items")
    assert sketches.count() == 4
    # the second product is frequent in one day's file, and over both
    hot = {r.slot for r in hot_slots(sketches, facts.LINE_REFERENCES[1], min_rows=100).collect()}
    named = {r.product_id: r.slot for r in tables.read_raw(job.warehouse, "order_items").select("product_id", slot(["product_id"]).alias("slot")).collect()}
    assert hot == {named["P2"]}
    write_day(job.raw_path, "order_items", NEXT, [])
    load(job, NEXT)
    assert tables.read_sketches(job.warehouse, "order_items").count() == 2


def folders(wh, layer, name):
    data = pathlib.Path(wh.location(layer, name), "data")
    return {p.name for p in data.iterdir()}


def test_cleaning_keeps_what_is_current(spark, wh):
    part = F.col("id").cast("string")
    tables.materialize(wh, MARTS, "t", spark.range(5), part)
    for n in range(3):
        tables.replace_parts(wh, MARTS, "t", spark.range(n, n + 1), part, [str(n)])
    tables.replace_parts(wh, MARTS, "t", spark.range(0), part, ["4"])
    pathlib.Path(wh.location(MARTS, "t"), "data", "left_by_a_failed_write").mkdir()
    assert len(folders(wh, MARTS, "t")) == 6  # a write without rows leaves an empty one
    tables.clean(wh)
    assert len(folders(wh, MARTS, "t")) == 6 and ids(tables.read_model(wh, MARTS, "t")) == [0, 1, 2, 3]
    location = wh.location(MARTS, "t")
    tables.clean(wh, NOW)
    assert len(list(pathlib.Path(location, "_commits").glob("*.json"))) == 1
    assert folders(wh, MARTS, "t") == {f.split("/data/")[1].split("/")[0] for f in wh.parts(MARTS, "t").values()}
    assert ids(tables.read_model(wh, MARTS, "t")) == [0, 1, 2, 3]
    # commits go on from the summary
    tables.replace_parts(wh, MARTS, "t", spark.range(9, 10), part, ["3"])
    assert ids(tables.read_model(wh, MARTS, "t")) == [0, 1, 2, 9]
    tables.clean(wh, NOW)
    assert ids(tables.read_model(wh, MARTS, "t")) == [0, 1, 2, 9]
    assert spark.table(wh.table(MARTS, "t")).count() == 4


def test_commit_that_a_summary_missed_still_holds(spark, wh):
    location = wh.location(MARTS, "t")
    tables.materialize(wh, MARTS, "t", spark.range(2), F.col("id").cast("string"))
    late = pathlib.Path(location, "_commits", f"{1:010d}-zz.json")
    tables.clean(wh, NOW)
    folder = commits.write(spark.range(5, 6), location)[commits.WHOLE]
    late.write_text(f'{{"at": "2024-01-01T00:00:00+00:00", "set": {{"5": "{folder}"}}, "drop": [], "whole": false, "replaced": []}}')
    assert ids(tables.read_model(wh, MARTS, "t")) == [0, 1, 5]
    tables.clean(wh, NOW)
    assert ids(tables.read_model(wh, MARTS, "t")) == [0, 1, 5]
