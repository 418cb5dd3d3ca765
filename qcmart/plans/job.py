"""Settings and outcome of a run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession

from qcmart.operators import dimensions
from qcmart.operators.quality import Rule
from qcmart.plans.rules import ALL_RULES
from qcmart.sources import commits, jdbc, tables
from qcmart.sources.schemas import RAW_TABLES
from qcmart.sources.tables import Warehouse

# Models copied to the serving database.
PUBLISHED = (
    "mart_daily_sales",
    "mart_store_performance",
    "mart_product_rankings",
    "dim_customers",
    "dim_products",
    "dim_stores",
    "fct_orders",
)


class QualityError(RuntimeError):
    """At least one check failed; its result is in the audit trail or kept failures."""


@dataclass
class Job:
    """Settings of a run. ``raw_path`` holds the CSV files, ``warehouse`` the tables."""

    spark: SparkSession
    raw_path: str
    warehouse: Warehouse
    min_daily_rows: int = 100
    as_of: Column | None = None
    tier_1: Sequence[str] = dimensions.TIER_1_CITIES
    calendar_start: dt.date = dimensions.CALENDAR_START
    calendar_end: dt.date = dimensions.CALENDAR_END
    holidays: Sequence[str] = dimensions.HOLIDAYS
    rules: Sequence[Rule] = ALL_RULES
    serving: jdbc.ServingDatabase | None = None
    published: Sequence[str] = PUBLISHED
    multiline: bool = False
    kept: dt.timedelta = commits.KEPT


@dataclass
class RunReport:
    """What a run did: counts of the text that came in and of what was wrong in it, rows loaded per raw table, its
    load days and the folders of the rows that came or went, failures per rule, failed daily checks, rows published."""

    extracted: dict[str, dict[str, int]] = field(default_factory=dict)
    dead_letters: dict[str, int] = field(default_factory=dict)
    loaded: dict[str, int] = field(default_factory=dict)
    loads: dict[str, list[str]] = field(default_factory=dict)
    touched: dict[str, list[str]] = field(default_factory=dict)
    failures: dict[str, int] = field(default_factory=dict)
    failed_checks: int = 0
    published: dict[str, int] = field(default_factory=dict)


def raw_tables(job: Job) -> dict[str, DataFrame]:
    return {f"raw_{t}": tables.read_raw(job.warehouse, t) for t in RAW_TABLES}
