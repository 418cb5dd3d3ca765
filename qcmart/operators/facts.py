"""Facts of the star schema: one row per order and one per order line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qcmart.functions import ratio, sql_round
from qcmart.operators.joins import lookup
from qcmart.operators.sizing import BROADCAST_BYTES, input_bytes
from qcmart.operators.sketches import key_sketches

# Keys by which the facts refer to other tables.
ORDER_REFERENCES = (("customer_id",), ("store_id",))
LINE_REFERENCES = (("order_id",), ("product_id",))

# Delivered within this many minutes counts as express.
EXPRESS_MINUTES = 15


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def fct_orders(
    orders: DataFrame,
    customers: DataFrame,
    stores: DataFrame,
    calendar: DataFrame,
    sketches: DataFrame | None = None,
    **bounds: int,
) -> DataFrame:
    """Orders with their dimension keys; unknown customers, stores and days keep NULL.

    Dimension keys must be unique, or orders multiply. ``sketches`` of ORDER_REFERENCES,
    where they are kept, spare a further pass over the orders.
    """
    kept = sketches is not None
    if not kept:
        sketches = key_sketches(orders, ORDER_REFERENCES)
    days = calendar.select("date_key", F.col("date_day").alias("order_date"))
    keyed = lookup(
        orders,
        customers.select("customer_id", "customer_key"),
        ["customer_id"],
        sketches,
        kept=kept,
        spread_by=["order_id"],
        **bounds,
    )
    keyed = lookup(
        keyed,
        stores.select("store_id", "store_key"),
        ["store_id"],
        sketches,
        kept=kept,
        spread_by=["order_id"],
        **bounds,
    )
    keyed = keyed.join(F.broadcast(days), "order_date", "left")
    status = F.col("status")
    express = (status == "delivered") & (F.col("delivery_minutes") <= EXPRESS_MINUTES)
    return keyed.select(
        "order_id",
        "date_key",
        "customer_key",
        "store_key",
        "city",
        "status",
        "total_amount",
        "delivery_minutes",
        "is_late",
        "order_hour",
        "order_dow",
        "is_weekend",
        "created_at",
        "order_date",
        _flag(status == "delivered").alias("is_delivered"),
        _flag(status == "cancelled").alias("is_cancelled"),
        _flag(status == "returned").alias("is_returned"),
        _flag(express).alias("is_express"),
    )


def fct_order_items(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    sketches: DataFrame | None = None,
    by_order: bool = False,
    **bounds: int,
) -> DataFrame:
    """Order lines with the keys, city and status of their order.

    ``orders`` is the order fact; lines of unknown orders and products keep NULL.
    ``sketches`` of LINE_REFERENCES, where they are kept, spare a further pass over the lines.
    Products too large for a broadcast come first, so that their shuffle does not carry the columns of the
    order; then the lines of an order lie together unless it is a hot one. Lines that lie ``by_order`` already meet their
    order first, without a shuffle.
    """
    kept = sketches is not None
    if not kept:
        sketches = key_sketches(items, LINE_REFERENCES)
    header = orders.select(
        "order_id", "date_key", "customer_key", "store_key", "city", "status"
    )
    # staging takes only lines with an order
    steps = [
        (header, ["order_id"], {"all_keyed": True}),
        (products.select("product_id", "product_key"), ["product_id"], {}),
    ]
    if not by_order and input_bytes(products) > bounds.get("broadcast_bytes", BROADCAST_BYTES):
        steps.reverse()
    keyed = items
    for table, keys, more in steps:
        more = more | bounds | {"kept": kept, "spread_by": ["order_item_id"]}
        keyed = lookup(keyed, table, keys, sketches, **more)
    price = sql_round(ratio(F.col("line_total"), F.col("qty")), 2)
    return keyed.select(
        "order_item_id",
        "order_id",
        "date_key",
        "customer_key",
        "store_key",
        "product_key",
        "city",
        "status",
        "qty",
        "unit_price",
        "line_total",
        "order_date",
        price.alias("effective_unit_price"),
    )
