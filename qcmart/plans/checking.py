"""Declared rules and daily checks on the stored tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qcmart.operators import quality
from qcmart.plans import models as m
from qcmart.plans.job import Job, raw_tables
from qcmart.sources import tables
from qcmart.sources.tables import QUALITY

def run_rules(job: Job, built: m.Models, keep_failures: bool = True) -> dict[str, int]:
    """Evaluate the declared rules; failing rows of a broken rule go to its own table.

    Returns the failures of every rule by rule name.
    """
    checked = raw_tables(job) | {name: built[name] for name in m.BUILD_ORDER}
    counts = quality.failure_counts(checked, job.rules).collect()
    by_rule = {(r.table_name, r.column_name, r.test): r.failing for r in counts}
    failures = {r.name: by_rule[(r.table, r.column, r.kind)] for r in job.rules}
    for rule in job.rules if keep_failures else ():
        if failures[rule.name]:
            rows = quality.failing_rows(checked[rule.table], rule)
            tables.materialize(job.warehouse, QUALITY, rule.name, rows)
        elif job.warehouse.exists(QUALITY, rule.name):
            tables.drop_model(job.warehouse, QUALITY, rule.name)
    return failures


def run_checks(job: Job, days: Sequence[dt.date]) -> int:
    """Evaluate the daily checks for all of ``days`` together and write the audit trail.

    Days without orders are skipped. Returns the number of failed checks.
    """
    wh, on_days = job.warehouse, F.col("date").isin(*days)

    def rows_of(table: str) -> DataFrame:
        loads = tables.loads_with(wh, table, lambda day: F.coalesce(day.isin(*days), F.lit(False)))
        return tables.read_raw(wh, table, loads).where(on_days)

    orders, items = rows_of("orders"), rows_of("order_items")
    # Orders of other days are read from the loads that hold one that is missing.
    missing = items.join(orders, "order_id", "left_anti").select(F.col("order_id").alias("id"))
    others = tables.load_days_of(tables.holders(wh, "orders", "order_id", missing))
    results = quality.daily_check_results(
        orders,
        items,
        all_orders=tables.read_raw(wh, "orders", others) if others else None,
        min_rows=job.min_daily_rows,
    )
    return tables.append_audit(job.warehouse, results)
