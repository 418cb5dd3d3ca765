"""Profiles of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qcmart.functions import quotient_avg, sql_round, to_dec
from qcmart.operators.sizing import broadcast_if_small


def profile_orders(raw_orders: DataFrame) -> DataFrame:
    """One row: size, span, reach and value of all orders."""
    money = to_dec(F.col("total_amount"), 12)
    return raw_orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.min("created_at").alias("earliest"),
        F.max("created_at").alias("latest"),
        F.count_distinct("store_id").alias("distinct_stores"),
        F.count_distinct("customer_id").alias("distinct_customers"),
        sql_round(quotient_avg(money), 2).alias("avg_order_value"),
        F.sum(money).alias("total_gmv"),
    )


def profile_status(raw_orders: DataFrame) -> DataFrame:
    """Orders per status with the share of all orders in percent, largest first."""
    counts = raw_orders.groupBy("status").agg(F.count(F.lit(1)).alias("cnt"))
    total = counts.agg(F.sum("cnt")).scalar()
    share = sql_round(F.col("cnt") * F.lit(100.0) / total, 1)
    return counts.withColumn("pct", share).orderBy(F.col("cnt").desc())


def profile_nulls(raw_order_items: DataFrame) -> DataFrame:
    """One row: order lines and how many lack an order, a product or a quantity."""

    def missing(column: str):
        lacks = F.when(F.col(column).isNull(), 1).otherwise(0)
        return F.sum(lacks).alias(f"null_{column}")

    return raw_order_items.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[missing(c) for c in ("order_id", "product_id", "qty")],
    )


def profile_category_gmv(raw_order_items: DataFrame, raw_products: DataFrame) -> DataFrame:
    """Order lines and rounded revenue per product category, largest first.

    Lines are summed per product before products are joined, so neither a hot
    product nor a hot category moves its lines through the shuffle.
    """
    per_product = raw_order_items.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(to_dec(F.col("line_total"), 12)).alias("revenue"),
    )
    named = raw_products.select("product_id", "category")
    return (
        per_product.join(broadcast_if_small(named), "product_id")
        .groupBy("category")
        .agg(
            F.sum("lines").alias("line_items"),
            sql_round(F.sum("revenue"), 0).alias("gmv"),
        )
        .orderBy(F.col("gmv").desc_nulls_last())
    )
