"""Checked size bounds behind which a broadcast or a one-task group is allowed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side whose input files are smaller than this may be broadcast.
BROADCAST_BYTES = 10 << 20

# Inputs smaller than this fit one task even if every row had the same key.
ONE_TASK_BYTES = 256 << 20


def input_bytes(df: DataFrame) -> int:
    """Bytes of all files and local rows that the plan of ``df`` reads.

    Sums the statistics of the plan's leaves. The planner's own estimate for the
    top of a plan multiplies the sides of every join and soon means nothing; the
    leaves are listed file sizes. A leaf of unknown size counts as huge.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (leaves.apply(i).stats().sizeInBytes() for i in range(leaves.size()))
    return sum(int(str(size)) for size in sizes)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast if its inputs are within ``limit``.

    Meant for dimensions, which hold one row per input row. Beyond the limit the
    frame is returned as it is and the join shuffles.
    """
    return F.broadcast(df) if input_bytes(df) <= limit else df
