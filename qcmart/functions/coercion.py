"""Coercion of untrusted text: what cannot be read becomes NULL, never an error."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that count as missing when a CSV file is loaded.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Texts read as a false flag; every other text, and a blank, is true.
FALSE_TOKENS = ("false", "0")


_NULL_LIST = ", ".join(f"'{token}'" for token in NULL_TOKENS)


def blank_to_null(column: str) -> Column:
    """NULL for any text of a column that stands for a missing value."""
    return F.expr(f"case when `{column}` not in ({_NULL_LIST}) then `{column}` end")


def as_timestamp(text: Column) -> Column:
    """Zone-free timestamp, NULL when unreadable."""
    return text.try_cast("timestamp_ntz")


def as_day(text: Column) -> Column:
    """Date, NULL when unreadable."""
    return text.try_cast("date")


def only(value: Column, keep: Callable[[Column], Column]) -> Column:
    """The value where ``keep`` holds of it, else NULL.

    The value stands once in the expression, so the optimizer can't multiply what makes it.
    """
    return F.get(F.filter(F.array(value), keep), F.lit(0))


def as_number(text: Column) -> Column:
    """Finite double, NULL when unreadable. Infinity and NaN, however spelled, are unreadable.

    A trailing ``d`` or ``f`` is Java's type suffix and not part of a number.
    """
    plain = only(text, lambda t: ~t.rlike(r"[dDfF][\x00-\x20]*$"))
    return only(plain.try_cast("double"), lambda number: F.abs(number) < float("inf"))


def as_whole_number(text: Column) -> Column:
    """Integer, halves to the even neighbour, NULL when unreadable or too large."""
    return F.rint(as_number(text)).try_cast("int")


def as_flag(text: Column) -> Column:
    """False for a false token, true for everything else including a blank."""
    return F.coalesce(~F.lower(F.trim(text)).isin(*FALSE_TOKENS), F.lit(True))
