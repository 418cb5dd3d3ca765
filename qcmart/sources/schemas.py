"""Table layouts of the raw layer and of the audit trail."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()
_DAY, _TS, _B = T.DateType(), T.TimestampNTZType(), T.BooleanType()


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


RAW_ORDERS = _table(
    ("order_id", _S),
    ("customer_id", _S),
    ("store_id", _S),
    ("city", _S),
    ("created_at", _TS),
    ("status", _S),
    ("total_amount", _D),
    ("delivery_minutes", _I),
    ("is_late", _B),
    ("date", _DAY),
)

RAW_ORDER_ITEMS = _table(
    ("order_item_id", _S),
    ("order_id", _S),
    ("product_id", _S),
    ("qty", _I),
    ("unit_price", _D),
    ("line_total", _D),
    ("date", _DAY),
)

RAW_PRODUCTS = _table(
    ("product_id", _S),
    ("name", _S),
    ("category", _S),
    ("subcategory", _S),
    ("mrp", _D),
)

RAW_CUSTOMERS = _table(
    ("customer_id", _S),
    ("name", _S),
    ("phone", _S),
    ("city", _S),
    ("tier", _I),
    ("state", _S),
    ("signup_date", _DAY),
)

RAW_STORES = _table(
    ("store_id", _S),
    ("city", _S),
    ("zone", _S),
    ("lat", _D),
    ("lon", _D),
)

AUDIT_LOG = _table(
    ("run_date", _DAY),
    ("table_name", _S),
    ("rows_loaded", T.LongType()),
    ("check_name", _S),
    ("status", _S),
    ("message", _S),
    ("loaded_at", _TS),
)

DAILY_TABLES = {"orders": RAW_ORDERS, "order_items": RAW_ORDER_ITEMS}
REFERENCE_TABLES = {
    "products": RAW_PRODUCTS,
    "customers": RAW_CUSTOMERS,
    "stores": RAW_STORES,
}
RAW_TABLES = {**DAILY_TABLES, **REFERENCE_TABLES}

# The day of the file a row came from. Raw tables are stored by (date, load_date):
# ``date`` prunes scans, ``load_date`` says which rows a reload of a day replaces.
LOAD_DATE = "load_date"
