"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for a NULL part inside a surrogate key.
NULL_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: Column) -> Column:
    """MD5 hex of the business key parts, joined by a hyphen."""
    texts = [F.coalesce(part.cast("string"), F.lit(NULL_PART)) for part in parts]
    return F.md5(texts[0] if len(texts) == 1 else F.concat_ws("-", *texts))
