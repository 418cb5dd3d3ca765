"""An index of which loads hold a key: hash buckets of keys, each with a filter of its bits.

Per load and key column, the distinct keys fall into buckets of about BUCKET_KEYS by hash. A row of
the index is one bucket: its keys, and a bitmap in which one bit per key is set, chosen by other bits
of the hash. To find the loads that hold some keys, the bitmaps of all loads are read, 4 KB a
bucket, and the keys only of buckets whose bitmap lets one of them through: about one in eight of
those that don't hold it, and all that do.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qcmart.operators.lineage import cut

BUCKET_KEYS = 4_096

#: Bits of a bitmap, as Spark's bitmap functions have them.
BITS = 32_768


def schema(per: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField(per, T.DateType()),
            T.StructField("key", T.StringType()),
            T.StructField("buckets", T.IntegerType()),
            T.StructField("bucket", T.IntegerType()),
            T.StructField("bitmap", T.BinaryType()),
            T.StructField("ids", T.ArrayType(T.StringType())),
        ]
    )


def _bucket() -> Column:
    return F.pmod(F.xxhash64("id"), F.col("buckets")).cast("int")


def _bit() -> Column:
    return F.pmod(F.shiftright(F.xxhash64("id"), 40), F.lit(BITS))


def key_index(rows: DataFrame, keys: Sequence[str], per: str) -> DataFrame:
    """The index of some text columns of ``rows``, for each value of ``per``. NULL keys are left out."""
    named = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("id")) for k in keys])
    each = rows.select(per, F.inline(named)).where("id is not null").distinct()
    sizes = each.groupBy(per, "key").agg(F.count(F.lit(1)).alias("n"))
    doubled = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / BUCKET_KEYS))).cast("int")
    sizes = sizes.select(per, "key", F.pow(F.lit(2), doubled).cast("int").alias("buckets"))
    # one row for each load and key column
    placed = each.join(F.broadcast(sizes), [per, "key"]).withColumns({"bucket": _bucket(), "bit": _bit()})
    return placed.groupBy(per, "key", "buckets", "bucket").agg(
        F.bitmap_construct_agg("bit").alias("bitmap"), F.array_sort(F.collect_list("id")).alias("ids")
    )


def let_through(index: DataFrame, key: str, ids: DataFrame, per: str) -> DataFrame:
    """(id, per, buckets, bucket) of the buckets that may hold one of ``ids`` (column id), by bitmap alone."""
    index = index.where(F.col("key") == key)
    # a power of two for each size of load: at most 31
    sizes = [r.buckets for r in index.select("buckets").distinct().collect()]
    asked = ids.select("id").where("id is not null").distinct()
    sizes = F.array(*[F.lit(s) for s in sizes]).cast("array<int>")
    asked = asked.select("id", F.explode(sizes).alias("buckets"))
    asked = asked.withColumns({"bucket": _bucket(), "bit": _bit()})
    byte = F.conv(F.hex(F.expr("substring(bitmap, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("long")
    is_set = F.getbit(byte, F.pmod(F.col("bit"), F.lit(8)).cast("int")) == 1
    found = asked.join(index.select(per, "buckets", "bucket", "bitmap"), ["buckets", "bucket"]).where(is_set)
    return found.select("id", per, "buckets", "bucket")


def holders(
    bitmaps: DataFrame,
    read: Callable[[Collection], DataFrame],
    key: str,
    ids: DataFrame,
    per: str,
) -> DataFrame:
    """(id, ``per``) of every load that holds one of ``ids``, exactly.

    ``bitmaps`` is the index of the loads to search; ``read`` reads it for some loads, of which it
    is asked only for those let through.
    """
    maybe = cut(let_through(bitmaps, key, ids, per))
    loads = [r[0] for r in maybe.select(per).distinct().collect()]
    index = read(loads).where(F.col("key") == key).select(per, "buckets", "bucket", "ids")
    found = maybe.join(index, [per, "buckets", "bucket"]).where(F.array_contains("ids", F.col("id")))
    return found.select("id", per)
