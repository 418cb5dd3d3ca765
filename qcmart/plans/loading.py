"""From raw files to the raw tables of the warehouse."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from qcmart.operators import cleaning
from qcmart.plans.job import Job, RunReport
from qcmart.sources import files, raw_files, tables
from qcmart.sources.schemas import DAILY_TABLES, LOAD_DATE, REFERENCE_TABLES

CLEANERS: Mapping[str, Callable[..., DataFrame]] = {
    "orders": cleaning.clean_orders,
    "order_items": cleaning.clean_order_items,
}


# Days that one Spark job loads and one commit adds, so that a backfill that stops keeps what it has.
DAYS_AT_ONCE = 100


def load_days(
    job: Job, days: Sequence[dt.date], report: RunReport, resume: bool = False
) -> None:
    """Read, clean and store the daily tables for ``days``.

    Days without a file are left as they are; with ``resume`` also those whose file is as it was when
    it was loaded last. DAYS_AT_ONCE days of a table are one Spark job,
    which also counts what came in; only if something was found wrong is the text read
    again to keep it.
    """
    for table in DAILY_TABLES:
        present = raw_files.days_present(job.spark, job.raw_path, table, days)
        name = f"raw_{table}"
        report.loaded[name], report.touched[name], report.loads[name] = 0, [], []
        report.extracted[table], report.dead_letters[table] = {"rows": 0}, 0
        inputs = {d: files.fingerprint(job.spark, raw_files.day_path(job.raw_path, table, d)) for d in present}
        if resume:
            known = tables.loaded_inputs(job.warehouse, table, [str(d) for d in present])
            present = [d for d in present if known.get(str(d)) != inputs[d]]
        for k in range(0, len(present), DAYS_AT_ONCE):
            some = present[k : k + DAYS_AT_ONCE]
            _load_some(job, table, some, report)
            tables.note_loaded(job.warehouse, table, {str(d): inputs[d] for d in some})


def _load_some(job: Job, table: str, days: Sequence[dt.date], report: RunReport) -> None:
    name = f"raw_{table}"
    text = raw_files.read_raw_days(job.spark, job.raw_path, table, days, job.multiline)
    seen = Observation()
    metrics = cleaning.load_metrics(table) | {"dead": F.sum(F.size(cleaning.findings(table)))}
    watched = text.observe(seen, *[c.alias(name) for name, c in metrics.items()])
    clean = CLEANERS[table](watched, order=raw_files.POSITION, per=[LOAD_DATE])
    rows, touched = tables.replace_days(job.warehouse, table, clean, days)
    report.loaded[name] += rows
    report.touched[name] += touched
    report.loads[name] += [d.isoformat() for d in days]
    counts = dict(seen.get)
    dead = counts.pop("dead") or 0
    report.dead_letters[table] += dead
    before = report.extracted[table]
    report.extracted[table] = {k: before.get(k, 0) + n for k, n in counts.items()}
    letters = cleaning.dead_letters(text, table, per=[LOAD_DATE]) if dead else None
    tables.keep_rejects(job.warehouse, table, letters, days, kind="dead_letters")
    if table == "order_items":
        rejected = cleaning.rejected_order_items(text)
        some = counts["fractional_qty"] > 0
        tables.keep_rejects(job.warehouse, table, rejected if some else None, days)


def load_references(job: Job, report: RunReport, resume: bool = False) -> None:
    """Replace the reference tables that have a file, with ``resume`` one that has changed."""
    for table in REFERENCE_TABLES:
        name = f"raw_{table}"
        report.loaded[name] = 0
        if raw_files.reference_present(job.spark, job.raw_path, table):
            input_ = files.fingerprint(job.spark, raw_files.reference_path(job.raw_path, table))
            if resume and tables.loaded_inputs(job.warehouse, table, ["all"]).get("all") == input_:
                continue
            rows = raw_files.read_reference(job.spark, job.raw_path, table, job.multiline)
            report.loaded[name] = tables.replace_reference(job.warehouse, table, rows)
            report.loads[name] = ["all"]
            tables.note_loaded(job.warehouse, table, {"all": input_})
