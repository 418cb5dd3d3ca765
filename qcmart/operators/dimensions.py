"""Dimensions of the star schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qcmart.functions import dow0, is_weekend, surrogate_key
from qcmart.operators.staging import banded

# Upper bounds of the customer segments by age in days, and the rest.
SEGMENTS = ((30, "New"), (180, "Growing"), (365, "Established"))
OLDEST_SEGMENT = "Loyal"

# Cities of the first tier.
TIER_1_CITIES = ("Mumbai", "Delhi", "Bangalore", "Hyderabad", "Chennai", "Pune")

# First and last calendar day, and holidays as month-day.
CALENDAR_START = dt.date(2023, 1, 1)
CALENDAR_END = dt.date(2026, 12, 31)
HOLIDAYS = ("01-26", "08-15", "10-02", "10-24", "11-01", "12-25")


def dim_customers(customers: DataFrame) -> DataFrame:
    age = F.col("customer_age_days")
    return customers.select(
        surrogate_key(F.col("customer_id")).alias("customer_key"),
        "customer_id",
        "customer_name",
        "city",
        "state",
        "city_tier",
        "signup_date",
        "customer_age_days",
        banded(age, SEGMENTS, OLDEST_SEGMENT).alias("customer_segment"),
    )


def dim_products(products: DataFrame) -> DataFrame:
    return products.select(
        surrogate_key(F.col("product_id")).alias("product_key"),
        "product_id",
        "product_name",
        "category",
        "subcategory",
        "mrp",
        "price_band",
    )


def dim_stores(stores: DataFrame, tier_1: Sequence[str] = TIER_1_CITIES) -> DataFrame:
    """A store without a city has no tier."""
    in_tier_1 = F.col("city").isin(*tier_1)
    return stores.select(
        surrogate_key(F.col("store_id")).alias("store_key"),
        "store_id",
        "city",
        "zone",
        "latitude",
        "longitude",
        F.when(in_tier_1, 1).when(~in_tier_1, 2).alias("city_tier"),
    )


def dim_date(
    spark: SparkSession,
    start: dt.date = CALENDAR_START,
    end: dt.date = CALENDAR_END,
    holidays: Sequence[str] = HOLIDAYS,
) -> DataFrame:
    """One row per calendar day; its size is fixed by ``start`` and ``end``."""
    days = spark.range(0, 1, 1, 1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date_day")
    )
    day = F.col("date_day")
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.day(day).alias("day"),
        F.weekofyear(day).alias("week_of_year"),
        F.quarter(day).alias("quarter"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_name"),
        dow0(day).alias("day_of_week"),
        is_weekend(day).alias("is_weekend"),
        F.date_format(day, "MM-dd").isin(*holidays).alias("is_holiday"),
        F.trunc(day, "month").alias("month_start"),
        F.last_day(day).alias("month_end"),
    )
