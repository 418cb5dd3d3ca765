"""Column helpers shared by the operators."""

from qcmart.functions.coercion import (
    NULL_TOKENS,
    as_day,
    as_flag,
    as_number,
    as_timestamp,
    as_whole_number,
    blank_to_null,
)
from qcmart.functions.keys import surrogate_key
from qcmart.functions.numeric import davg, pct, quotient_avg, ratio, sql_round, to_dec
from qcmart.functions.timeparts import dow0, is_weekend

__all__ = [
    "NULL_TOKENS",
    "as_day",
    "as_flag",
    "as_number",
    "as_timestamp",
    "as_whole_number",
    "blank_to_null",
    "davg",
    "dow0",
    "is_weekend",
    "pct",
    "quotient_avg",
    "ratio",
    "sql_round",
    "surrogate_key",
    "to_dec",
]
