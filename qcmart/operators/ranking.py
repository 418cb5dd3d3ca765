"""Dense ranks whose groups may be too large for one task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from qcmart.operators.lineage import cut


def _offsets(placed: DataFrame, value: str, out: str, groups: list[str]) -> DataFrame:
    """What is to be added to the ranks within a part, by (``__part``, ``__group``): the number of
    distinct values in earlier parts of the group, less a last one that goes on in this part.

    Values are structs, in which a NULL equals a NULL and sorts last.
    """
    one = F.struct(F.col(value).alias("v"))
    parts = placed.groupBy("__part", F.struct(*groups).alias("__group")).agg(
        F.max(out).alias("__n"), F.max(one).alias("__top"), F.min(one).alias("__low")
    )
    before = W.partitionBy("__group").orderBy("__part")
    goes_on = F.lag("__low").over(before).eqNullSafe(F.col("__top")).cast("long")
    parts = parts.withColumn("__again", goes_on)
    earlier = F.sum(F.expr("__n - __again")).over(before.rowsBetween(W.unboundedPreceding, -1))
    offset = F.coalesce(earlier, F.lit(0)) - F.col("__again")
    return parts.select("__part", "__group", offset.alias("__offset"))


def dense_rank_spread(
    df: DataFrame, value: str, ranks: Mapping[str, list[str]], parts: int | None = None
) -> DataFrame:
    """Add a dense rank of the column ``value``, highest first, for each of ``ranks``: name of the rank
    to its grouping columns.

    Rows are dealt into ranges of (columns common to all groups, value), so that the values of every group
    fall from one part to the next; one exchange serves all ranks. Equal values may lie in several
    parts. Rows are ranked within their part, and a table of one row per part and group
    tells how many values come before. So no window sorts more than a part, whatever the groups and ties,
    save for rows that are equal in all columns, which lie together. NULL values rank last. ``df`` is
    written once to the shared folder, in parts; Spark sets their number unless ``parts`` does.
    """
    common = [c for c in df.columns if all(c in groups for groups in ranks.values())]
    falling = F.col(value).desc_nulls_last()
    order = [*common, falling, F.xxhash64(*df.columns)]
    dealt = df.repartitionByRange(*order) if parts is None else df.repartitionByRange(parts, *order)
    placed = dealt.withColumn("__part", F.spark_partition_id())
    # the fewest columns first: their exchange serves the other windows too
    for out, groups in sorted(ranks.items(), key=lambda r: len(r[1])):
        within = W.partitionBy("__part", *groups).orderBy(falling)
        placed = placed.withColumn(out, F.dense_rank().over(within).cast("long"))
    ranked = placed = cut(placed)
    for out, groups in ranks.items():
        ranked = ranked.withColumn("__group", F.struct(*groups))
        ranked = ranked.join(_offsets(placed, value, out, groups), ["__part", "__group"])
        ranked = ranked.withColumn(out, F.col(out) + F.col("__offset")).drop("__group", "__offset")
    return ranked.select(*df.columns, *ranks)
