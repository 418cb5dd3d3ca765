"""Rounding and averaging that agree with a SQL warehouse to the last digit.

Spark rounds the shortest decimal text of a double, the warehouse rounds the
double itself, so ``round(1.005, 2)`` differs between the two. Averages and
ratios of exact decimals are computed as one division of two exact numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_round(x: Column, digits: int = 0) -> Column:
    """Round a double half away from zero after scaling it by a power of ten."""
    if digits == 0:
        return F.round(x.cast("double"))
    scale = F.lit(float(10**digits))
    return F.round(x.cast("double") * scale) / scale


def to_dec(x: Column, precision: int, digits: int = 2) -> Column:
    """Double to fixed-point decimal, rounding the double and not its text; NULL where it doesn't fit."""
    return sql_round(x, digits).try_cast(f"decimal({precision},{digits})")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division of exact numbers, NULL when the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0)).cast("double")


def quotient_avg(money: Column) -> Column:
    """Average as the sum over the count, for use next to a sum of the same column.

    The warehouse divides the two when a query asks for both and works in whole
    cents, as ``davg``, when it asks for the average alone. The results may differ in
    the last binary digit, which shows when a rounded digit is an exact tie.
    """
    return ratio(F.sum(money), F.count(money))


def davg(money: Column) -> Column:
    """Average of a two-digit decimal as a double: whole cents over whole cents."""
    cents = (F.sum(money) * F.lit(100)).cast("double")
    return cents / (F.nullif(F.count(money), F.lit(0)) * F.lit(100.0))


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage of two counts, NULL when the whole is zero."""
    return sql_round(part * F.lit(100.0) / F.nullif(whole, F.lit(0)), digits)
