"""The daily job on small CSV layouts: loads, reloads, backfill, gates."""

from __future__ import annotations

import collections
import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from qcmart.operators import cleaning, marts, profiling
from qcmart.plans import building, checking, daily, loading, models
from qcmart.plans.job import Job, QualityError, RunReport, raw_tables
from qcmart.sources import files, raw_files, tables
from qcmart.sources.tables import MARTS, QUALITY, Warehouse
from tests.rawfiles import (
    ITEM_HEADER,
    REFERENCES,
    item,
    order,
    write_day,
    write_full_day,
    write_references,
)

DAY = dt.date(2024, 3, 15)
NEXT = dt.date(2024, 3, 16)
LAST = dt.date(2024, 4, 1)
COUNT = iter(range(1000))


@pytest.fixture
def job(spark, tmp_path):
    raw = tmp_path / "raw"
    write_references(raw)
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"), prefix=f"t{next(COUNT)}_")
    return Job(spark, str(raw), warehouse, as_of=F.lit("2024-12-31").cast("date"))


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def stored(job):
    found = {n: rows(tables.read_model(job.warehouse, MARTS, n)) for n in models.BUILD_ORDER}
    return found | {n: rows(df) for n, df in raw_tables(job).items()}


def test_one_day(job):
    write_full_day(job.raw_path, DAY)
    report = daily.run_day(job, DAY)
    assert report.loaded == {
        "raw_orders": 120,
        "raw_order_items": 120,
        "raw_products": 2,
        "raw_customers": 2,
        "raw_stores": 2,
    }
    assert report.extracted["orders"] == {"rows": 120, "unreadable_flags": 0}
    assert len(report.failures) == 35 and not any(report.failures.values())
    audit = tables.read_audit(job.warehouse).orderBy("check_name").collect()
    assert [(r.check_name, r.status, r.message, r.rows_loaded) for r in audit] == [
        ("raw_order_items: referential integrity", "PASS", "0", 120),
        ("raw_orders: min daily rows", "PASS", "120", 120),
        ("raw_orders: no duplicate order_ids", "PASS", "0", 120),
        ("raw_orders: no nulls on order_id", "PASS", "0", 120),
        ("raw_orders: positive total_amount", "PASS", "0", 120),
    ]
    assert all(r.run_date == DAY and r.loaded_at for r in audit)
    sales = daily.read_mart(job, "mart_daily_sales").collect()
    assert [r.city for r in sales] == ["Jaipur", "Pune"]
    assert sum(r.total_orders for r in sales) == 120
    catalog = job.warehouse.table(tables.RAW, "raw_orders")
    assert job.spark.table(catalog).count() == 120
    assert job.spark.table("stg_orders").count() == 120


def test_backfill_equals_single_days_and_a_reload(job, spark, tmp_path):
    for day in (DAY, NEXT):
        write_full_day(job.raw_path, day)
    daily.run_range(job, DAY, NEXT)
    single = Job(
        spark,
        job.raw_path,
        Warehouse(spark, str(tmp_path / "single"), prefix=f"t{next(COUNT)}_"),
        as_of=job.as_of,
    )
    for day in (DAY, NEXT, DAY):
        daily.run_day(single, day)
    assert stored(job) == stored(single)


def load(job, *days):
    tables.ensure_tables(job.warehouse)
    report = RunReport()
    loading.load_days(job, days, report)
    return report


def raw_counts(job, table):
    raw = raw_tables(job)[table]
    return {r["date"]: r["count"] for r in raw.groupBy("date").count().collect()}


def test_changed_file_replaces_its_rows_only(job):
    write_full_day(job.raw_path, DAY)
    write_full_day(job.raw_path, NEXT)
    # A row of the next day's file that carries the first day's date.
    late = [order(i, NEXT) for i in range(120)] + [order(900, DAY)]
    write_day(job.raw_path, "orders", NEXT, late)
    load(job, DAY, NEXT)
    assert raw_counts(job, "raw_orders") == {DAY: 121, NEXT: 120}
    load(job, DAY)
    assert raw_counts(job, "raw_orders") == {DAY: 121, NEXT: 120}
    write_day(job.raw_path, "orders", NEXT, [order(i, NEXT) for i in range(110)])
    load(job, NEXT)
    assert raw_counts(job, "raw_orders") == {DAY: 120, NEXT: 110}


def test_missing_day_is_skipped(job):
    write_full_day(job.raw_path, DAY)
    load(job, DAY)
    assert load(job, NEXT).loaded == {"raw_orders": 0, "raw_order_items": 0}
    assert raw_counts(job, "raw_orders") == {DAY: 120}


def test_day_whose_rows_are_all_dropped_empties_it(job):
    write_full_day(job.raw_path, DAY)
    write_full_day(job.raw_path, NEXT)
    load(job, DAY, NEXT)
    write_day(job.raw_path, "orders", NEXT, [order(1, NEXT, order_id="")])
    write_day(job.raw_path, "order_items", NEXT, [])
    report = load(job, NEXT)
    assert report.loaded == {"raw_orders": 0, "raw_order_items": 0}
    assert report.extracted["orders"]["rows"] == 1
    assert raw_counts(job, "raw_orders") == {DAY: 120}
    assert raw_counts(job, "raw_order_items") == {DAY: 120}


def failed_checks(job):
    failed = tables.read_audit(job.warehouse).where("status = 'FAIL'").collect()
    return {(r.check_name, r.message, r.rows_loaded) for r in failed}


def test_failed_check_is_audited_before_it_stops_the_run(job):
    job.min_daily_rows = 500
    write_full_day(job.raw_path, DAY)
    write_day(job.raw_path, "orders", DAY, [order(i, DAY) for i in range(119)])
    with pytest.raises(QualityError, match="2 daily checks"):
        daily.run_day(job, DAY)
    assert failed_checks(job) == {
        ("raw_orders: min daily rows", "119", 119),
        ("raw_order_items: referential integrity", "1", 120),
    }


def test_each_order_check_finds_its_violation(job):
    write_full_day(job.raw_path, DAY)
    write_full_day(job.raw_path, NEXT)
    bad = [order(i, DAY) for i in range(118)]
    bad += [order(118, DAY, total_amount="0"), order(119, DAY, total_amount="-5")]
    write_day(job.raw_path, "orders", DAY, bad)
    twice = [order(i, NEXT) for i in range(120)] + [order(1, DAY, date=str(NEXT))]
    write_day(job.raw_path, "orders", NEXT, twice)
    load(job, DAY, NEXT)
    # The same order id in the files of two days, both dated the second day.
    again = [order(i, DAY) for i in range(118)] + [order(1, NEXT)]
    write_day(job.raw_path, "orders", DAY, bad + again[-1:])
    load(job, DAY)
    assert checking.run_checks(job, [DAY, NEXT]) == 2
    assert failed_checks(job) == {
        ("raw_orders: positive total_amount", "2", 120),
        ("raw_orders: no duplicate order_ids", "1", 122),
    }


def test_item_of_an_earlier_day_is_no_orphan(job):
    write_full_day(job.raw_path, DAY)
    write_full_day(job.raw_path, NEXT)
    extra = item(500, NEXT, order_id=f"O{DAY:%d}0001")
    lines = [item(i, NEXT) for i in range(120)]
    write_day(job.raw_path, "order_items", NEXT, [*lines, extra])
    load(job, DAY, NEXT)
    assert checking.run_checks(job, [NEXT]) == 0


def test_broken_rule_keeps_its_rows(job):
    write_full_day(job.raw_path, DAY)
    bad = [order(i, DAY) for i in range(119)] + [order(119, DAY, status="lost")]
    write_day(job.raw_path, "orders", DAY, bad)
    rule = "accepted_values_raw_orders_status"
    with pytest.raises(QualityError, match=rule):
        daily.run_day(job, DAY)
    kept = tables.read_model(job.warehouse, QUALITY, rule).collect()
    assert [r.order_id for r in kept] == [f"O{DAY:%d}0119"]
    write_full_day(job.raw_path, DAY)
    daily.run_day(job, DAY)
    assert not job.warehouse.exists(QUALITY, rule)


def test_repeated_dimension_key_stops_before_facts(job):
    write_references(job.raw_path, stores=[["S1", "Pune", "a", "1", "2"], ["S1", "Pune", "b", "1", "2"]])
    write_full_day(job.raw_path, DAY)
    with pytest.raises(QualityError, match="raw_stores.store_id"):
        daily.run_day(job, DAY)
    assert not job.warehouse.exists(MARTS, "fct_orders")


def test_fractional_quantities_are_kept_aside(job):
    write_full_day(job.raw_path, DAY)
    lines = [item(i, DAY) for i in range(119)] + [item(119, DAY, qty="1.5")]
    write_day(job.raw_path, "order_items", DAY, lines)
    report = load(job, DAY)
    assert report.loaded["raw_order_items"] == 119
    assert report.extracted["order_items"] == {"rows": 120, "fractional_qty": 1}
    rejected = tables.read_model(job.warehouse, QUALITY, "rejected_order_items")
    assert [r.qty for r in rejected.collect()] == ["1.5"]
    write_full_day(job.raw_path, DAY)
    load(job, DAY)
    assert not job.warehouse.parts(QUALITY, "rejected_order_items")


def test_bad_amounts_are_kept_aside_and_the_build_goes_on(job):
    write_full_day(job.raw_path, DAY)
    orders = [order(i, DAY) for i in range(116)]
    orders += [
        order(116, DAY, total_amount="1e11"),
        order(117, DAY, total_amount="9999999999.99"),
        order(118, DAY, customer_id="", delivery_minutes="soon", is_late="maybe"),
        order(119, DAY, created_at="never", date="?"),
    ]
    write_day(job.raw_path, "orders", DAY, orders)
    lines = [item(i, DAY) for i in range(117)]
    lines += [
        item(117, DAY, qty="1.5", line_total="12f"),
        item(118, DAY, qty="99999999999", unit_price="1e8"),
        item(119, DAY, qty="NA", line_total="inf"),
    ]
    write_day(job.raw_path, "order_items", DAY, lines)
    report = load(job, DAY)
    loading.load_references(job, RunReport())
    assert report.dead_letters == {"orders": 6, "order_items": 5}

    def letters(table):
        kept = tables.read_model(job.warehouse, QUALITY, f"dead_letters_{table}").collect()
        assert {r.load_date for r in kept} == {DAY}
        return {(r.row_key[-3:], r.column_name, r.value, r.reason, r.rejected) for r in kept}

    assert letters("orders") == {
        ("116", "total_amount", "1e11", "out of range", False),
        ("118", "customer_id", None, "missing key", True),
        ("118", "delivery_minutes", "soon", "unreadable", False),
        ("118", "is_late", "maybe", "unreadable", False),
        ("119", "created_at", "never", "unreadable", True),
        ("119", "date", "?", "unreadable", False),
    }
    assert letters("order_items") == {
        ("117", "qty", "1.5", "fractional", True),
        ("117", "line_total", "12f", "unreadable", False),
        ("118", "qty", "99999999999", "out of range", False),
        ("118", "unit_price", "1e8", "out of range", False),
        ("119", "line_total", "inf", "unreadable", False),
    }
    raw = {r.order_id[-3:]: r.total_amount for r in raw_tables(job)["raw_orders"].collect()}
    assert raw["116"] == 1e11 and len(raw) == 118
    built = building.build_models(job)
    totals = {r.order_id[-3:]: r.total_amount for r in built.fct_orders.collect()}
    assert len(totals) == 117 and "116" not in totals and float(totals["117"]) == 9999999999.99
    # a file without faults takes its letters back
    write_full_day(job.raw_path, DAY)
    assert load(job, DAY).dead_letters == {"orders": 0, "order_items": 0}
    assert not job.warehouse.parts(QUALITY, "dead_letters_orders")


def test_backfill_resumes_where_it_stopped(job, spark, tmp_path, monkeypatch):
    days = [DAY + dt.timedelta(n) for n in range(4)]
    for day in days:
        write_full_day(job.raw_path, day)
    monkeypatch.setattr(loading, "DAYS_AT_ONCE", 1)
    loads, replace_days = [], tables.replace_days

    def counted(wh, table, rows, load_dates, stop=None):
        if (table, load_dates[0]) == stop:
            raise ConnectionError("lost")
        loads.extend((table, d) for d in load_dates)
        return replace_days(wh, table, rows, load_dates)

    monkeypatch.setattr(tables, "replace_days", lambda *a: counted(*a, stop=("orders", days[2])))
    with pytest.raises(ConnectionError):
        daily.run_range(job, days[0], days[-1], resume=True)
    assert loads == [("orders", d) for d in days[:2]]
    monkeypatch.setattr(tables, "replace_days", counted)
    loads.clear()
    report = daily.run_range(job, days[0], days[-1], resume=True)
    assert loads == [("orders", d) for d in days[2:]] + [("order_items", d) for d in days]
    assert report.loaded["raw_orders"] == 240 and report.loaded["raw_order_items"] == 480

    # nothing changed: nothing is loaded or built; a changed file is
    built = []
    build_models = building.build_models
    monkeypatch.setattr(building, "build_models", lambda job: built.append(1) or build_models(job))
    loads.clear()
    daily.run_range(job, days[0], days[-1], resume=True)
    assert not loads and not built
    write_day(job.raw_path, "orders", days[1], [order(i, days[1]) for i in range(110)])
    write_day(job.raw_path, "order_items", days[1], [item(i, days[1]) for i in range(110)])
    daily.run_range(job, days[0], days[-1], resume=True)
    assert loads == [("orders", days[1]), ("order_items", days[1])] and built == [1]

    at_once = Job(
        spark, job.raw_path, Warehouse(spark, str(tmp_path / "at_once"), prefix=f"t{next(COUNT)}_"), as_of=job.as_of
    )
    daily.run_range(at_once, days[0], days[-1])
    assert stored(job) == stored(at_once)


def test_no_orders_means_no_checks(job):
    report = daily.run_day(job, DAY)
    assert report.failed_checks == 0
    assert tables.read_audit(job.warehouse).count() == 0


def test_tables_survive_a_lost_catalog(job):
    write_full_day(job.raw_path, DAY)
    load(job, DAY)
    database = job.warehouse.database(tables.RAW)
    job.spark.sql(f"drop database {database} cascade")
    tables.ensure_tables(job.warehouse)
    assert job.spark.table(job.warehouse.table(tables.RAW, "raw_orders")).count() == 120


def test_columns_are_taken_by_name(job):
    lines = [dict(zip(ITEM_HEADER, item(1, DAY))) | {"extra": "x"}]
    header = ["extra", *reversed(ITEM_HEADER)]
    write_day(job.raw_path, "order_items", DAY, [[r[c] for c in header] for r in lines], header)
    read = raw_files.read_raw_day(job.spark, job.raw_path, "order_items", DAY).first()
    assert [read[c] for c in ITEM_HEADER] == item(1, DAY)
    assert read.load_date == DAY


def test_missing_column_is_an_error(job):
    write_day(job.raw_path, "order_items", DAY, [["1"]], ["order_id"])
    with pytest.raises(ValueError, match="order_item_id"):
        raw_files.read_raw_day(job.spark, job.raw_path, "order_items", DAY)


def test_files_with_different_headers_fail_together(job):
    write_full_day(job.raw_path, DAY)
    write_day(job.raw_path, "orders", NEXT, [], ["date", "order_id"])
    with pytest.raises(Exception, match="(?i)header"):
        raw_files.read_raw_all(job.spark, job.raw_path, "orders").collect()


def test_all_days_in_one_scan(job):
    write_full_day(job.raw_path, DAY, 3)
    write_full_day(job.raw_path, NEXT, 4)
    both = raw_files.read_raw_all(job.spark, job.raw_path, "orders")
    counts = {r.load_date: r["count"] for r in both.groupBy("load_date").count().collect()}
    assert counts == {DAY: 3, NEXT: 4}


def test_missing_reference_reads_as_no_rows(job, tmp_path):
    read = raw_files.read_reference(job.spark, str(tmp_path / "nowhere"), "products")
    assert read.count() == 0 and read.columns[0] == "product_id"


def test_reference_values_must_fit(job):
    write_references(job.raw_path, products=[["P1", "a", "b", "c", "cheap"]])
    with pytest.raises(Exception, match="cheap"):
        raw_files.read_reference(job.spark, job.raw_path, "products").collect()


def test_incremental_runs_equal_a_full_build(job, monkeypatch):
    for day in (DAY, NEXT, LAST):
        write_full_day(job.raw_path, day)
    # A line of the last day that belongs to an order of the first.
    late = item(700, LAST, order_id=f"O{DAY:%d}0001")
    write_day(job.raw_path, "order_items", LAST, [*[item(i, LAST) for i in range(120)], late])
    daily.run_range(job, DAY, LAST, incremental=True)

    # The first day changes: fewer orders, one with a new status; a new customer comes.
    orders = [order(i, DAY) for i in range(100)]
    orders[1] = order(1, DAY, status="delivered", total_amount="999.99")
    orders.append(order(800, DAY, customer_id="C3"))
    write_day(job.raw_path, "orders", DAY, orders)
    write_day(job.raw_path, "order_items", DAY, [item(i, DAY) for i in range(100)])
    customers = REFERENCES["customers"][1] + [["C3", "Dev", "", "Pune", "1", "M", "2024-07-01"]]
    write_references(job.raw_path, customers=customers)
    builds = []
    full_build = building.build_models

    def build(job):
        builds.append("full")
        return full_build(job)

    monkeypatch.setattr(building, "build_models", build)
    daily.run_day(job, DAY, incremental=True)
    assert not builds
    refreshed = stored(job)

    # A run after one that stopped half way builds everything.
    files.mark(job.spark, f"{job.warehouse.path}/_models_pending")
    daily.run_day(job, DAY, incremental=True)
    assert builds == ["full"]
    assert stored(job) == refreshed

    # A known store moves, which reaches all days: everything is built.
    write_references(job.raw_path, customers=customers, stores=[["S1", "Goa", "z", "1", "2"]])
    daily.run_day(job, NEXT, incremental=True)
    assert builds == ["full"] * 2
    cities = {r.city for r in daily.read_mart(job, "mart_store_performance").collect()}
    assert cities == {"Goa"}


def test_incremental_run_reads_only_loads_that_hold_its_keys(job):
    """Files of loads that no key or day leads to may even be unreadable."""
    month = [DAY + dt.timedelta(n) for n in range(-40, 2)]
    for day in (month[0], month[1], DAY, NEXT):
        write_full_day(job.raw_path, day)
    # A line of an early day belongs to an order that comes last, and a row has no date.
    early = item(900, month[0], order_id="late-order")
    write_day(job.raw_path, "order_items", month[0], [*[item(i, month[0]) for i in range(120)], early])
    daily_rows = [order(i, NEXT) for i in range(120)] + [order(700, NEXT, date="")]
    write_day(job.raw_path, "orders", NEXT, daily_rows)
    load(job, *month)
    loading.load_references(job, RunReport())
    building.build_models(job)
    write_day(job.raw_path, "orders", DAY, [*[order(i, DAY) for i in range(110)], order(1, DAY, order_id="late-order")])
    report = load(job, DAY)

    def unreadable(layer, name, part):
        """Its files with junk in place of their rows; what they were."""
        folder = pathlib.Path(job.warehouse.parts(layer, name)[part])
        before = {f: f.read_bytes() for f in [*folder.glob("*.parquet"), *folder.glob(".*.crc")]}
        for file in before:
            file.write_bytes(b"junk") if file.suffix == ".parquet" else file.unlink()
        return before

    unread = [unreadable(tables.RAW, t, str(month[1])) for t in ("raw_orders", "raw_order_items")]
    unread += [unreadable(MARTS, t, str(month[1])) for t in ("fct_orders",)]
    building.refresh_models(job, report)
    assert checking.run_checks(job, [DAY]) == 1  # lines of orders that are no more
    for file, content in [x for before in unread for x in before.items()]:
        file.write_bytes(content)
    refreshed = stored(job)
    lines = tables.read_model(job.warehouse, MARTS, "fct_order_items").where("order_id = 'late-order'")
    assert [r.customer_key is not None for r in lines.collect()] == [True]
    building.build_models(job)
    assert stored(job) == refreshed


def test_month_from_daily_state_equals_that_from_the_facts(job):
    days = [DAY, NEXT, LAST]
    for day in days:
        write_full_day(job.raw_path, day)
    # buyers of several days count once, and orders outside the calendar and of unknown stores not at all
    orders = [order(i, NEXT) for i in range(118)]
    orders += [order(118, NEXT, date="1999-01-01"), order(119, NEXT, store_id="S9", customer_id="C9")]
    write_day(job.raw_path, "orders", NEXT, orders)
    load(job, *days)
    loading.load_references(job, RunReport())
    built = building.build_models(job)
    months = marts.monthly_sales(built.order_counters, built.order_buyers, built.dim_date)
    got = {(r.year, r.month, r.city): r for r in months.collect()}
    assert len(got) == 4
    facts = [r for r in built.fct_orders.collect() if r.date_key is not None]
    for (year, month, city), r in got.items():
        own = [o for o in facts if (o.date_key // 100, o.city) == (year * 100 + month, city)]
        delivered = [o for o in own if o.status == "delivered"]
        minutes = [o.delivery_minutes for o in delivered if o.delivery_minutes is not None]
        hours = collections.Counter(o.order_hour for o in own)
        assert r.total_orders == len(own) and r.total_gmv == sum(o.total_amount for o in own)
        assert r.net_revenue == sum(o.total_amount for o in delivered)
        assert r.unique_customers == len({o.customer_key for o in own if o.customer_key})
        assert r.avg_delivery_minutes == pytest.approx(sum(minutes) / len(minutes), abs=0.051)
        assert r.peak_hour == min(h for h in hours if hours[h] == max(hours.values()))
        assert r.late_pct == pytest.approx(100 * sum(o.is_late for o in own) / len(delivered), abs=0.0051)


def test_profiles_of_raw_files(job):
    write_references(job.raw_path)
    write_full_day(job.raw_path, DAY, 4)
    write_full_day(job.raw_path, NEXT, 2)
    orders = cleaning.coerce_orders(raw_files.read_raw_all(job.spark, job.raw_path, "orders"))
    row = profiling.profile_orders(orders).first()
    assert (row.total_orders, row.distinct_stores, row.distinct_customers) == (6, 2, 2)
    assert (float(row.total_gmv), row.avg_order_value) == (610.0, 101.67)
    shares = [(r.status, r.cnt, r.pct) for r in profiling.profile_status(orders).collect()]
    assert shares == [("delivered", 4, 66.7), *sorted(shares[1:])]
    lines = cleaning.coerce_order_items(
        raw_files.read_raw_all(job.spark, job.raw_path, "order_items")
    )
    assert profiling.profile_nulls(lines).first().total_rows == 6
    products = raw_files.read_reference(job.spark, job.raw_path, "products")
    gmv = {r.category: r.line_items for r in profiling.profile_category_gmv(lines, products).collect()}
    assert gmv == {"Dairy": 3, "Grocery": 3}
