"""The index of the loads that hold a key."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from qcmart.operators import key_index

DAYS = [dt.date(2024, 1, 1) + dt.timedelta(n) for n in range(6)]


@pytest.fixture(scope="module")
def rows(spark):
    """Loads of 20, 2,000 and 20,000 keys; some keys in several loads, one in a third of the rows."""
    size = F.expr("case id % 3 when 0 then 20 when 1 then 2000 else 20000 end")
    df = spark.range(0, 120_000, 1, 6).select(
        F.expr("date_add(date'2024-01-01', cast(id % 6 as int))").alias("load_date"),
        F.when(F.col("id") % 7 == 0, None)
        .when(F.col("id") % 3 == 0, "hot")
        .otherwise(F.concat(F.lit("k"), F.pmod(F.col("id") * 7, size).cast("string")))
        .alias("k"),
        F.lit("one").alias("other"),
    )
    return df.cache()


def test_holders_are_exact(spark, rows):
    index = key_index.key_index(rows, ["k", "other"], "load_date").cache()
    asked = spark.createDataFrame([("hot",), ("k13",), ("k700",), ("k19999",), ("no",), (None,), ("one",)], "id string")
    asked_loads = []

    def read(loads):
        asked_loads.append(set(loads))
        return index.where(F.col("load_date").isin(*loads))

    got = {tuple(r) for r in key_index.holders(index, read, "k", asked, "load_date").collect()}
    held = rows.join(asked, rows.k == asked.id).select("id", "load_date").distinct()
    assert got == {tuple(r) for r in held.collect()} and len(got) > 5
    assert not key_index.holders(index, read, "k", asked.where("id = 'no'"), "load_date").collect()
    assert asked_loads[-1] < set(DAYS)


def test_filters_let_few_through(spark, rows):
    index = key_index.key_index(rows, ["k"], "load_date")
    absent = spark.range(4_000).select(F.concat(F.lit("absent"), F.col("id").cast("string")).alias("id"))
    through = key_index.let_through(index, "k", absent, "load_date").count()
    assert through < 0.2 * 4_000 * len(DAYS)
    large = index.groupBy("load_date").agg(F.max(F.size("ids")).alias("n"), F.max("buckets").alias("b"))
    assert all(r.n < 2 * key_index.BUCKET_KEYS for r in large.collect())


def test_nothing_indexed(spark, rows):
    none = key_index.key_index(rows.limit(0), ["k"], "load_date")
    asked = spark.createDataFrame([("hot",)], "id string")
    assert key_index.holders(none, lambda loads: none, "k", asked, "load_date").count() == 0
