"""The models in dependency order: staging, dimensions, facts, daily state of orders, marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qcmart.operators import dimensions, facts, marts, staging

STAGING = ("stg_orders", "stg_order_items", "stg_products", "stg_customers", "stg_stores")
DIMENSIONS = ("dim_customers", "dim_products", "dim_stores", "dim_date")
FACTS = ("fct_orders", "fct_order_items")
MARTS = ("mart_daily_sales", "mart_store_performance", "mart_product_rankings")
STATE = ("order_counters", "order_buyers")
BUILD_ORDER = DIMENSIONS + FACTS + STATE + MARTS

# Columns that name the part of a stored model that a row belongs to.
PARTITIONS = {
    "fct_orders": ("order_date",),
    "fct_order_items": ("order_date",),
    "order_counters": ("order_date",),
    "order_buyers": ("order_date",),
    "mart_daily_sales": ("date_day",),
    "mart_store_performance": ("date_day",),
    "mart_product_rankings": ("year", "month"),
}

# The part of rows whose day is missing or outside the calendar.
OTHER_DAYS = "other"


def part_of(name: str, start: dt.date, end: dt.date) -> Column | None:
    """The part of a stored model that a row belongs to: a day of the calendar, other days, or a month."""
    by = PARTITIONS.get(name)
    if by is None:
        return None
    if by == ("order_date",):
        return day_part(F.col("order_date"), start, end)
    return F.concat_ws("-", *[F.col(c).cast("string") for c in by])


def day_part(day: Column, start: dt.date, end: dt.date) -> Column:
    known = F.when(day.between(F.lit(start), F.lit(end)), day.cast("string"))
    return F.coalesce(known, F.lit(OTHER_DAYS))


@dataclass
class Models:
    """The models over a set of raw tables, each built when first asked for.

    ``raw`` maps ``raw_orders`` and its siblings to DataFrames; ``sketches``, where they
    are kept, ``raw_orders`` and ``raw_order_items`` to sketches of their keys. ``by_order``: raw order lines
    lie by order.
    """

    spark: SparkSession
    raw: Mapping[str, DataFrame] | Callable[[str], DataFrame]
    as_of: Column | None = None
    tier_1: Sequence[str] = dimensions.TIER_1_CITIES
    calendar_start: dt.date = dimensions.CALENDAR_START
    calendar_end: dt.date = dimensions.CALENDAR_END
    holidays: Sequence[str] = dimensions.HOLIDAYS
    sketches: Mapping[str, DataFrame] | Callable[[str], DataFrame] = field(default_factory=dict)
    by_order: bool = False

    def use(self, name: str, df: DataFrame) -> None:
        """Take ``df`` as the model ``name`` from now on, typically its written table."""
        self.__dict__[name] = df

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    def _raw(self, name: str) -> DataFrame:
        return self.raw(name) if callable(self.raw) else self.raw[name]

    def _sketches(self, name: str) -> DataFrame | None:
        return self.sketches(name) if callable(self.sketches) else self.sketches.get(name)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self._raw("raw_orders"))

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self._raw("raw_order_items"))

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self._raw("raw_products"))

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self._raw("raw_customers"), self.as_of)

    @cached_property
    def stg_stores(self) -> DataFrame:
        return staging.stg_stores(self._raw("raw_stores"))

    @cached_property
    def dim_customers(self) -> DataFrame:
        return dimensions.dim_customers(self.stg_customers)

    @cached_property
    def dim_products(self) -> DataFrame:
        return dimensions.dim_products(self.stg_products)

    @cached_property
    def dim_stores(self) -> DataFrame:
        return dimensions.dim_stores(self.stg_stores, self.tier_1)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.dim_date(
            self.spark, self.calendar_start, self.calendar_end, self.holidays
        )

    @cached_property
    def fct_orders(self) -> DataFrame:
        return facts.fct_orders(
            self.stg_orders,
            self.dim_customers,
            self.dim_stores,
            self.dim_date,
            self._sketches("raw_orders"),
        )

    @cached_property
    def fct_order_items(self) -> DataFrame:
        return facts.fct_order_items(
            self.stg_order_items,
            self.fct_orders,
            self.dim_products,
            self._sketches("raw_order_items"),
            by_order=self.by_order,
        )

    @cached_property
    def order_counters(self) -> DataFrame:
        return marts.order_counters(self.fct_orders)

    @cached_property
    def order_buyers(self) -> DataFrame:
        return marts.order_buyers(self.fct_orders)

    @cached_property
    def mart_daily_sales(self) -> DataFrame:
        if "order_counters" not in self.__dict__:
            return marts.mart_daily_sales(self.fct_orders, self.dim_date)
        return marts.daily_sales(self.order_counters, self.order_buyers, self.dim_date)

    @cached_property
    def mart_store_performance(self) -> DataFrame:
        return marts.store_performance(
            self.order_counters, self.order_buyers, self.dim_stores, self.dim_date
        )

    @cached_property
    def mart_product_rankings(self) -> DataFrame:
        return marts.mart_product_rankings(
            self.fct_order_items, self.dim_products, self.dim_date
        )
