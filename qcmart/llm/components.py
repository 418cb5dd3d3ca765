"""Connected components of a large graph given as pairs of ids.

Each task first contracts its own pairs with a union-find forest. The forests are then merged by
alternating star steps, each a grouped minimum and a join, until nothing changes. Nothing is
collected and no node's neighbours meet in a task: joins on a node with very many neighbours are
split by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qcmart.llm import common

PAIRS = "u long, v long"


def _forest(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (node, smallest node that this task's pairs connect it to)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in rows:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    pairs = [(x, root(x)) for x in list(parent)]
    pairs = [p for p in pairs if p[0] != p[1]]
    for at in range(0, len(pairs), 50_000):
        u, v = zip(*pairs[at : at + 50_000], strict=True)
        yield pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _step(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.where("u <> v").distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(id, component) of every id that a pair (u, v) connects; component is the smallest id."""
    pairs = common.stored(pairs.select("u", "v").mapInArrow(_forest, PAIRS).distinct())
    seen = None
    while True:
        mark = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        pairs = common.stored(_step(pairs))
    roots = pairs.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
