"""Raw text rows to typed, keyed, deduplicated rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qcmart.functions import (
    as_day,
    as_flag,
    as_number,
    as_timestamp,
    as_whole_number,
    blank_to_null,
)
from qcmart.sources.schemas import RAW_ORDER_ITEMS, RAW_ORDERS

ORDER_KEYS = ["order_id", "customer_id", "store_id", "created_at"]
ITEM_KEYS = ["order_item_id", "order_id", "product_id"]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in ``order``; NULL keys count as one key.

    Catalyst limits each key to one row inside every map task before the shuffle,
    so a key that holds a third of all rows sends one row per task. The hash of a key with
    text leads the sort because ids share long prefixes and a number decides at once.
    """
    sorting = [F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]
    text = any(isinstance(df.schema[k].dataType, T.StringType) for k in keys)
    first = W.partitionBy(*([F.xxhash64(*keys)] if text else []), *keys).orderBy(*sorting)
    return df.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")


def drop_incomplete(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any of ``keys``."""
    return df.dropna(how="any", subset=list(keys))


def _blanks_to_null(text: DataFrame, columns: Sequence[str]) -> DataFrame:
    return text.withColumns({c: blank_to_null(c) for c in columns})


def coerce_orders(text: DataFrame) -> DataFrame:
    """Type the text columns of orders; missing and unreadable values become NULL."""
    return _blanks_to_null(text, RAW_ORDERS.names).withColumns(
        {
            "created_at": as_timestamp(F.col("created_at")),
            "total_amount": as_number(F.col("total_amount")),
            "delivery_minutes": as_whole_number(F.col("delivery_minutes")),
            "is_late": as_flag(F.col("is_late")),
            "date": as_day(F.col("date")),
        }
    )


def coerce_order_items(text: DataFrame) -> DataFrame:
    """Type the text columns of order lines; missing and unreadable values become NULL."""
    return _blanks_to_null(text, RAW_ORDER_ITEMS.names).withColumns(
        {
            "qty": as_whole_number(F.col("qty")),
            "unit_price": as_number(F.col("unit_price")),
            "line_total": as_number(F.col("line_total")),
            "date": as_day(F.col("date")),
        }
    )


def clean_orders(
    text: DataFrame, order: Sequence[str | Column], per: Sequence[str] = ()
) -> DataFrame:
    """Typed orders with complete keys, one per order id (within each ``per`` value).

    ``order`` says which copy of an id came first; ``per`` is the load day when
    several daily files are cleaned together.
    """
    keyed = drop_incomplete(coerce_orders(text), ORDER_KEYS)
    kept = keep_first(keyed, [*per, "order_id"], order)
    return kept.select(*RAW_ORDERS.names, *per)


def fractional_qty() -> Column:
    """True for a readable quantity that is not a whole number."""
    part = F.exists(F.array(as_number(F.col("qty"))), lambda qty: qty != F.rint(qty))
    return F.coalesce(part, F.lit(False))


def clean_order_items(
    text: DataFrame, order: Sequence[str | Column], per: Sequence[str] = ()
) -> DataFrame:
    """Typed order lines with complete keys, one per line id (within each ``per`` value).

    Lines with a fractional quantity are left to ``rejected_order_items``.
    """
    keyed = drop_incomplete(coerce_order_items(text.where(~fractional_qty())), ITEM_KEYS)
    kept = keep_first(keyed, [*per, "order_item_id"], order)
    return kept.select(*RAW_ORDER_ITEMS.names, *per)


def rejected_order_items(text: DataFrame) -> DataFrame:
    """Order lines whose quantity is a number but not a whole one, as they came."""
    return text.where(fractional_qty())


def unreadable_flag(column: str) -> Column:
    """True for a present text that is neither true nor false."""
    text = blank_to_null(column)
    known = F.lower(F.trim(text)).isin("true", "false", "1", "0")
    return F.coalesce(~known, F.lit(False))


def load_metrics(table: str) -> dict[str, Column]:
    """Counts taken while the text of a daily table passes by, without a further scan."""
    counts = {"rows": F.count(F.lit(1))}
    if table == "orders":
        counts["unreadable_flags"] = F.count_if(unreadable_flag("is_late"))
    if table == "order_items":
        counts["fractional_qty"] = F.count_if(fractional_qty())
    return counts


# Digits before the point that the models keep of an amount.
AMOUNT_DIGITS = {"total_amount": 10, "unit_price": 8, "line_total": 10}

NUMBERS = {"orders": ("total_amount", "delivery_minutes"), "order_items": ("qty", "unit_price", "line_total")}
MOMENTS = {"created_at": as_timestamp, "date": as_day}


def dead_letters(text: DataFrame, table: str, per: Sequence[str] = ()) -> DataFrame:
    """One row for each value that is lost or costs its row its place: (``per``, row_key, column_name,
    value, reason, rejected).

    Reasons are ``missing key``, ``unreadable``, ``out of range`` and ``fractional``. ``rejected`` says that
    the row goes; otherwise only the value does, or the total keeps the order out of the models.
    """
    key = "order_id" if table == "orders" else "order_item_id"
    return text.select(*per, F.col(key).alias("row_key"), F.inline(findings(table)))


def findings(table: str) -> Column:
    """The array of a raw row's findings, see ``dead_letters``."""
    keys = ORDER_KEYS if table == "orders" else ITEM_KEYS
    found = []
    for column in [f.name for f in (RAW_ORDERS if table == "orders" else RAW_ORDER_ITEMS).fields]:
        present = blank_to_null(column)
        reason = F.when(present.isNull(), "missing key") if column in keys else F.lit(None).cast("string")
        if column in NUMBERS[table]:
            reason = F.get(F.transform(F.array(as_number(present)), partial(_number_finding, column)), F.lit(0))
            reason = F.when(present.isNotNull(), reason)
        elif column in MOMENTS:
            unreadable = present.isNotNull() & MOMENTS[column](present).isNull()
            reason = F.when(unreadable, "unreadable").otherwise(reason)
        elif column == "is_late":
            reason = F.when(unreadable_flag(column), "unreadable")
        elif column not in keys:
            continue
        rejected = (reason == "fractional") | F.lit(column in keys)
        found.append(
            F.struct(F.lit(column).alias("column_name"), F.col(column).alias("value"), reason.alias("reason"), rejected.alias("rejected"))
        )
    return F.filter(F.array(*found), lambda f: f["reason"].isNotNull())


def _number_finding(column: str, number: Column) -> Column:
    reason = F.when(number.isNull(), "unreadable")
    if column in AMOUNT_DIGITS:
        largest = 10 ** AMOUNT_DIGITS[column] - 0.005
        return reason.when(F.abs(number) >= largest, "out of range")
    if column == "qty":
        reason = reason.when(number != F.rint(number), "fractional")
    return reason.when(F.rint(number).try_cast("int").isNull(), "out of range")
