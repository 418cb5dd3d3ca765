"""Frequent keys of large tables from mergeable sketches.

A sketch of a key column tracks a fixed number of its most frequent values, whatever the size
of the table; sketches of parts merge into that of the whole. So they are taken once, of the rows
of a load, kept by load day and merged, instead of counting every key of the table again.

A sketch holds key slots: hashes of keys, equal for equal keys of any column type.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keys that a sketch tracks. Counts are off by at most 3.5 / 8192 of all rows.
TRACKED = 4_000

# A key with more than one row in this many is hot, so at most this many keys are.
HOT_FRACTION = 1_000

# Below this many rows a key is never worth separating.
HOT_ROWS = 1_000_000

# Sketches that one task merges at most in the first of two steps, by tasks that made them.
PARTS = 64

SKETCH = T.StructType(
    [
        T.StructField("sketch", T.BinaryType()),
        T.StructField("maxItemsTracked", T.IntegerType()),
        T.StructField("itemDataType", T.LongType()),
        T.StructField("itemDataTypeDDL", T.StringType()),
    ]
)
SKETCHES = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("key_rows", T.LongType()), T.StructField("sketch", SKETCH)]
)


def slot(keys: Sequence[str], kinds: Mapping[str, T.DataType] | None = None) -> Column:
    """A number for a key, never negative. ``kinds``: the types to compare keys in."""
    values = [F.col(k).cast(kinds[k]) if kinds else F.col(k) for k in keys]
    return F.shiftrightunsigned(F.xxhash64(*values), 1)


def _present(keys: Sequence[str]) -> str:
    return " and ".join(f"`{k}` is not null" for k in keys)


def name_of(keys: Sequence[str]) -> str:
    return ",".join(keys)


def key_sketches(
    rows: DataFrame, keys: Sequence[Sequence[str]], per: Sequence[str] = ()
) -> DataFrame:
    """(``per``, key, key_rows, sketch) of each of ``keys``, all from one pass over ``rows``.

    Every task sends a sketch, whatever its rows, and sketches are merged in two steps.
    NULL keys are left out.
    """
    columns = {f"__s{n}": slot(k) for n, k in enumerate(keys)}
    columns |= {f"__ok{n}": F.expr(_present(k)) for n, k in enumerate(keys)}
    each = rows.select(*per, *[c.alias(n) for n, c in columns.items()])
    some = each.groupBy(*per, F.pmod(F.spark_partition_id(), F.lit(PARTS)).alias("__part")).agg(
        *[
            F.expr(f"approx_top_k_accumulate(__s{n}, {TRACKED}) filter (where __ok{n})").alias(f"__s{n}")
            for n in range(len(keys))
        ],
        *[F.count_if(f"__ok{n}").alias(f"__n{n}") for n in range(len(keys))],
    )
    named = [
        F.struct(
            F.lit(name_of(k)).alias("key"), F.col(f"__n{n}").alias("key_rows"), F.col(f"__s{n}").alias("sketch")
        )
        for n, k in enumerate(keys)
    ]
    parts = some.select(*per, F.inline(F.array(*named)))
    return merged(parts.where("key_rows > 0"), [*per, "key"])


def merged(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of the same ``by`` values merged into one."""
    return sketches.groupBy(*by).agg(
        F.sum("key_rows").alias("key_rows"),
        F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch"),
    )


def hot_slots(sketches: DataFrame, key: Sequence[str], min_rows: int = HOT_ROWS) -> DataFrame:
    """Column ``slot``: the keys that hold a large share of all sketched rows, at most HOT_FRACTION."""
    whole = merged(sketches.where(F.col("key") == name_of(key)), ["key"])
    found = whole.select(
        "key_rows", F.explode(F.expr(f"approx_top_k_estimate(sketch, {HOT_FRACTION})")).alias("top")
    )
    many = (F.col("top.count") * HOT_FRACTION > F.col("key_rows")) & (F.col("top.count") >= min_rows)
    return found.where(many).select(F.col("top.item").alias("slot"))


def hot_among(sketches: DataFrame, key: Sequence[str], min_rows: int = HOT_ROWS) -> list[int]:
    """The slots of ``hot_slots``, found now: at most HOT_FRACTION numbers."""
    return sorted(r["slot"] for r in hot_slots(sketches, key, min_rows).collect())
