"""Calendar parts with Sunday as day zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dow0(moment: Column) -> Column:
    """Day of week, Sunday = 0 to Saturday = 6."""
    return F.dayofweek(moment) - 1


def is_weekend(moment: Column) -> Column:
    """True on Saturday and Sunday; False otherwise, also for NULL."""
    return F.coalesce(F.dayofweek(moment).isin(1, 7), F.lit(False))
