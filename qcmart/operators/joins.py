"""Left join of facts to a keyed table that stays balanced under hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qcmart.operators.sizing import BROADCAST_BYTES, ONE_TASK_BYTES, input_bytes
from qcmart.operators.sketches import HOT_ROWS, hot_among, hot_slots, key_sketches, slot

# Rows that do not meet a partner in the shuffle are spread over this many values.
SPREAD = 1 << 20

# Rows that do meet one have one of these values, by their key. So few pack to nothing in the shuffle.
OWN_SLOTS = 2


def _both(columns: list[Column]) -> Column:
    return reduce(and_, columns)


def lookup(
    facts: DataFrame,
    table: DataFrame,
    keys: list[str],
    sketches: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    one_task_bytes: int = ONE_TASK_BYTES,
    hot_rows: int = HOT_ROWS,
    kept: bool = False,
    hot: Sequence[int] | None = None,
    spread_by: Sequence[str] | None = None,
    all_keyed: bool = False,
) -> DataFrame:
    """``facts`` left join ``table`` on equally named ``keys``.

    A small table is broadcast. A large one is shuffled, and then the rows of hot
    keys and of NULL keys would pile up in single tasks: hot keys are joined with a
    broadcast of just their rows of the table, and all rows that need no partner
    from the shuffle are spread over it evenly. Every row is kept either way. Inputs
    small enough for one task skip the search for hot keys.

    Hot keys come from ``sketches`` of the facts (see ``key_sketches``), which only steer
    which way a row takes; without any, the keys are read once more to sketch them. Sketches that
    are ``kept`` are asked at once, so that without hot keys no rows are marked and ``table`` is read
    once; ``hot`` tells the slots of hot keys if they are known. Rows are spread by the columns ``spread_by``, all of them
    unless told, which the shuffle then has to carry. Where hot keys are known to be none and
    ``all_keyed`` says that no key is NULL, nothing is spread and rows stay where their key puts them.
    ``table`` should hold at most a few rows per key, as a dimension does.
    """
    if input_bytes(table) <= broadcast_bytes:
        return facts.join(F.broadcast(table), keys, "left")
    if input_bytes(facts) <= one_task_bytes:
        return facts.join(table, keys, "left")

    if hot is None and sketches is not None and kept:
        hot = hot_among(sketches, keys, hot_rows)
    if all_keyed and hot is not None and not hot:
        return facts.join(table, keys, "left")

    columns = [c for c in table.columns if c not in keys]
    kinds = {f.name: f.dataType for f in facts.schema.fields}
    own = slot(keys, kinds)
    if hot is None:
        sketches = key_sketches(facts, [keys]) if sketches is None else sketches
        found = hot_slots(sketches, keys, hot_rows)
        found = F.broadcast(found.select(F.col("slot").alias("__own"), F.lit(True).alias("__hot")))
        hot_table = table.withColumn("__own", own).join(found, "__own", "left_semi")
        marked = facts.withColumn("__own", own).join(found, "__own", "left")
        is_hot = F.col("__hot").isNotNull()
    else:
        is_hot = own.isin(*hot) if hot else F.lit(False)
        hot_table, marked = table.where(is_hot), facts
    if hot is None or hot:
        hot_table = hot_table.select(
            *keys, F.lit(True).alias("__found"), *[F.col(c).alias(f"__hot_{c}") for c in columns]
        )
        marked = marked.join(F.broadcast(hot_table), keys, "left")
    has_no_partner = is_hot | ~_both([F.col(k).isNotNull() for k in keys])
    # The slot joins the shuffle key. Rows with a partner share a slot that follows from the key,
    # never negative; all others get negative slots, which meet nothing. The hash keeps
    # the optimizer from reducing the slot to a constant and dropping it from the key.
    spread = -1 - F.pmod(F.xxhash64(*(spread_by or facts.columns)), F.lit(SPREAD))
    few = F.pmod(own, F.lit(OWN_SLOTS))
    marked = marked.withColumn("__slot", F.when(has_no_partner, spread).otherwise(few))
    joined = marked.join(table.withColumn("__slot", few), [*keys, "__slot"], "left")
    if hot is not None and not hot:
        return joined.select(*keys, *[c for c in facts.columns if c not in keys], *columns)
    return joined.select(
        *keys,
        *[F.col(c) for c in facts.columns if c not in keys],
        *[
            F.when(F.col("__found").isNotNull(), F.col(f"__hot_{c}"))
            .otherwise(F.col(c))
            .alias(c)
            for c in columns
        ],
    )
