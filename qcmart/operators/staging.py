"""Staging: typed projections of the raw tables with the rows the star schema accepts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qcmart.functions import dow0, is_weekend, to_dec

# Upper bounds of the price bands by list price, and the band above.
PRICE_BANDS = ((50, "Budget"), (150, "Mid-range"), (500, "Premium"))
TOP_PRICE_BAND = "Luxury"


def banded(value: Column, bands: tuple[tuple[int, str], ...], top: str) -> Column:
    """Label of the first band whose upper bound exceeds ``value``; NULL gets the top."""
    label = F
    for bound, name in bands:
        label = label.when(value < bound, name)
    return label.otherwise(top)


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    """Orders with their keys and a positive total that fits twelve digits."""
    moment = F.col("created_at").cast("timestamp_ntz")
    accepted = raw_orders.where(
        "order_id is not null and customer_id is not null and total_amount > 0"
    )
    return accepted.select(
        "order_id",
        "customer_id",
        "store_id",
        "city",
        moment.alias("created_at"),
        F.col("date").cast("date").alias("order_date"),
        F.lower(F.trim("status")).alias("status"),
        to_dec(F.col("total_amount"), 12).alias("total_amount"),
        F.col("delivery_minutes").cast("int").alias("delivery_minutes"),
        F.col("is_late").cast("boolean").alias("is_late"),
        F.hour(moment).alias("order_hour"),
        dow0(moment).alias("order_dow"),
        is_weekend(moment).alias("is_weekend"),
    ).where("total_amount is not null")


def stg_order_items(raw_order_items: DataFrame) -> DataFrame:
    accepted = raw_order_items.where(
        "order_item_id is not null and order_id is not null and qty > 0"
    )
    return accepted.select(
        "order_item_id",
        "order_id",
        "product_id",
        F.col("qty").cast("int").alias("qty"),
        to_dec(F.col("unit_price"), 10).alias("unit_price"),
        to_dec(F.col("line_total"), 12).alias("line_total"),
        F.col("date").cast("date").alias("order_date"),
    )


def stg_products(raw_products: DataFrame) -> DataFrame:
    return raw_products.where(F.col("product_id").isNotNull()).select(
        "product_id",
        F.trim("name").alias("product_name"),
        F.trim("category").alias("category"),
        F.trim("subcategory").alias("subcategory"),
        to_dec(F.col("mrp"), 10).alias("mrp"),
        banded(F.col("mrp"), PRICE_BANDS, TOP_PRICE_BAND).alias("price_band"),
    )


def stg_customers(raw_customers: DataFrame, as_of: Column | None = None) -> DataFrame:
    """``as_of`` is the day ages are counted to; today unless given."""
    signup = F.col("signup_date").cast("date")
    today = F.current_date() if as_of is None else as_of
    return raw_customers.where(F.col("customer_id").isNotNull()).select(
        "customer_id",
        F.trim("name").alias("customer_name"),
        F.trim("city").alias("city"),
        F.trim("state").alias("state"),
        F.col("tier").cast("int").alias("city_tier"),
        signup.alias("signup_date"),
        F.date_diff(today, signup).alias("customer_age_days"),
    )


def stg_stores(raw_stores: DataFrame) -> DataFrame:
    return raw_stores.where(F.col("store_id").isNotNull()).select(
        "store_id",
        F.trim("city").alias("city"),
        F.trim("zone").alias("zone"),
        F.col("lat").cast("double").alias("latitude"),
        F.col("lon").cast("double").alias("longitude"),
    )
