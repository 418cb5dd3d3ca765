"""The daily job and the backfill of a range of days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from qcmart.operators.marts import MART_ORDER, in_mart_order
from qcmart.plans import building, checking, loading
from qcmart.plans import models as m
from qcmart.plans.job import Job, QualityError, RunReport
from qcmart.sources import files, jdbc, raw_files, tables
from qcmart.sources.tables import MARTS

def publish(job: Job, built: m.Models) -> dict[str, int]:
    """Copy the published models to the serving database; rows per table."""
    if job.serving is None:
        return {}
    jdbc.ensure_schema(job.spark, job.serving)
    return {
        name: jdbc.publish(job.spark, built[name], job.serving, name)
        for name in job.published
    }


def read_mart(job: Job, name: str) -> DataFrame:
    """A stored model; marts come in their presentation order."""
    stored = tables.read_model(job.warehouse, MARTS, name)
    return in_mart_order(stored, name) if name in MART_ORDER else stored


def run_range(
    job: Job, start: dt.date, end: dt.date, incremental: bool = False, resume: bool = False
) -> RunReport:
    """Load all days of the range in one go, build the models once, check, publish.

    All models are rebuilt unless ``incremental``, which rewrites only what the days
    reach and gives the same tables. With ``resume``, files that were loaded as they are
    now, by this run before it stopped or by another, are not loaded again, and models
    that nothing has changed since are not built again.
    A broken rule or check stops the run after its result has been written and
    before anything is published.
    """
    days = raw_files.days_between(start, end)
    tables.ensure_tables(job.warehouse)
    report = RunReport()
    # Set from the first load to the last model: a run that finds it follows one that
    # stopped in between, and cannot tell from its own days what is out of date.
    pending = f"{job.warehouse.path}/_models_pending"
    stopped = files.exists(job.spark, pending)
    files.mark(job.spark, pending)
    loading.load_days(job, days, report, resume)
    loading.load_references(job, report, resume)
    if resume and not stopped and not any(report.loads.values()):
        built = building.stored_models(job)
    elif incremental and not stopped:
        built = building.refresh_models(job, report)
    else:
        built = building.build_models(job)
    files.remove_tree(job.spark, pending)
    report.failures = checking.run_rules(job, built)
    broken = sorted(name for name, n in report.failures.items() if n)
    if broken:
        raise QualityError(f"failed rules: {', '.join(broken)}")
    if report.loaded["raw_orders"] or resume:
        report.failed_checks = checking.run_checks(job, days)
    if report.failed_checks:
        raise QualityError(f"{report.failed_checks} daily checks failed")
    report.published = publish(job, built)
    tables.clean(job.warehouse, job.kept)
    return report


def run_day(job: Job, day: dt.date, incremental: bool = False) -> RunReport:
    """The daily job for one day."""
    return run_range(job, day, day, incremental)
