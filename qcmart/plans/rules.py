"""The declared expectations on raw tables and models."""

from __future__ import annotations

from qcmart.operators.quality import Rule

# The status domain.
STATUSES = ("delivered", "cancelled", "returned")


def _rules(table: str, **columns: str) -> list[Rule]:
    return [
        Rule(table, column, kind)
        for column, kinds in columns.items()
        for kind in kinds.split()
    ]


REQUIRED_KEY = "not_null unique"

SOURCE_RULES: tuple[Rule, ...] = (
    *_rules(
        "raw_orders", order_id=REQUIRED_KEY, customer_id="not_null", store_id="not_null"
    ),
    Rule("raw_orders", "status", "accepted_values", values=STATUSES),
    *_rules(
        "raw_order_items",
        order_item_id=REQUIRED_KEY,
        order_id="not_null",
        product_id="not_null",
    ),
    *_rules("raw_products", product_id=REQUIRED_KEY),
    *_rules("raw_customers", customer_id=REQUIRED_KEY),
    *_rules("raw_stores", store_id=REQUIRED_KEY),
)

MODEL_RULES: tuple[Rule, ...] = (
    *_rules("dim_date", date_key=REQUIRED_KEY, date_day=REQUIRED_KEY),
    *_rules("dim_customers", customer_key=REQUIRED_KEY, customer_id=REQUIRED_KEY),
    *_rules("dim_products", product_key=REQUIRED_KEY),
    *_rules("dim_stores", store_key=REQUIRED_KEY),
    *_rules("fct_orders", order_id=REQUIRED_KEY, total_amount="not_null"),
    Rule("fct_orders", "total_amount", "expression", expression=">= 0"),
    Rule("fct_orders", "status", "accepted_values", values=STATUSES),
    *_rules("fct_order_items", order_item_id=REQUIRED_KEY),
    Rule("fct_order_items", "qty", "expression", expression="> 0"),
)

ALL_RULES = SOURCE_RULES + MODEL_RULES

# Keys that must be unique before facts are joined to dimensions.
DIMENSION_KEY_RULES = tuple(
    r
    for r in SOURCE_RULES
    if r.kind == "unique" and r.table in ("raw_products", "raw_customers", "raw_stores")
)
