"""What keeps the plans standing at scale: balanced joins and ranks, bounded plans."""

from __future__ import annotations

import contextlib
import re

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

import __spark_entry__ as entry
from qcmart.operators import facts, marts
from qcmart.operators.cleaning import keep_first
from qcmart.operators.joins import lookup
from qcmart.operators.lineage import cut
from qcmart.operators.ranking import dense_rank_spread
from qcmart.operators.sizing import broadcast_if_small, input_bytes
from qcmart.operators.sketches import hot_slots, key_sketches, merged, slot

# Bounds that make every input count as large.
LARGE = {"broadcast_bytes": 0, "one_task_bytes": 0, "hot_rows": 1}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@contextlib.contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows has one known key, a third an unknown one, a sixth none."""
    key = (
        F.when(F.col("id") % 6 < 2, "hot")
        .when(F.col("id") % 6 < 4, "nowhere")
        .when(F.col("id") % 6 == 4, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
    )
    facts = spark.range(0, 60_000, 1, 4).select("id", key.alias("k"))
    name = F.concat(F.lit("k"), F.col("id").cast("string"))
    table = spark.range(0, 400).select(
        F.when(F.col("id") == 7, "hot").otherwise(name).alias("k"), F.col("id").alias("v")
    )
    return facts, table


def test_lookup_equals_left_join(skewed):
    facts, table = skewed
    expected = rows(facts.join(table, ["k"], "left"))
    assert rows(lookup(facts, table, ["k"])) == expected
    assert rows(lookup(facts, table, ["k"], **LARGE)) == expected
    assert rows(lookup(facts, table, ["k"], broadcast_bytes=0)) == expected


def test_lookup_keeps_every_match_of_a_hot_key(spark, skewed):
    facts, table = skewed
    table = table.unionAll(spark.sql("select 'hot', 9L"))
    assert rows(lookup(facts, table, ["k"], **LARGE)) == rows(facts.join(table, ["k"], "left"))


def test_lookup_on_two_keys(spark, skewed):
    facts, table = skewed
    facts = facts.withColumn("b", F.col("id") % 2)
    table = table.withColumn("b", F.col("v") % 2)
    expected = rows(facts.join(table, ["k", "b"], "left"))
    assert rows(lookup(facts, table, ["k", "b"], **LARGE)) == expected


def test_hot_rows_do_not_meet_in_one_task(spark, skewed):
    facts, table = skewed
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}

    def largest_share(joined):
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        return max(r["count"] for r in sizes) / facts.count()

    with settings(spark, **conf):
        assert largest_share(facts.join(table, ["k"], "left")) > 0.3
        spread = lookup(facts, table, ["k"], **LARGE)
        assert largest_share(spread) < 0.2
        shuffles = [line for line in plan(spread).splitlines() if "Exchange hash" in line]
        assert sum("__slot" in line for line in shuffles) == 2


def _hot(facts, sketches, key, **bounds):
    found = hot_slots(sketches, [key], **bounds)
    return {r[key] for r in facts.withColumn("slot", slot([key])).join(found, "slot", "left_semi").collect()}


def test_hot_keys(skewed):
    facts, _ = skewed
    sketches = key_sketches(facts, [["k"], ["id"]])
    assert _hot(facts, sketches, "k", min_rows=1000) == {"hot", "nowhere"}
    assert _hot(facts, sketches, "k", min_rows=1_000_000) == set()
    assert _hot(facts, sketches, "id", min_rows=1) == set()
    rows_of = {r.key: r.key_rows for r in sketches.collect()}
    assert rows_of == {"k": 50_000, "id": 60_000}


def test_sketches_of_days_merge_into_that_of_all(spark, skewed):
    facts, _ = skewed
    # each day a key of its own is frequent; only one is over all days
    daily = facts.withColumn("day", F.expr("id div 100"))
    daily = daily.withColumn("k", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("day").cast("string")))
    by_day = key_sketches(daily, [["k"]], per=["day"])
    assert by_day.count() == 600
    whole = merged(by_day, ["key"])
    assert [r.key_rows for r in whole.collect()] == [60_000]
    assert _hot(daily, by_day, "k", min_rows=1000) == _hot(daily, whole, "k", min_rows=1000) == {"hot"}


def test_sketches_find_all_frequent_keys(spark):
    """Among very many rare keys, those with over one row in a thousand."""
    keys = F.when(F.col("id") % 500 < 3, F.col("id") % 500).otherwise(F.col("id") + 1000)
    rows_ = spark.range(0, 400_000, 1, 8).select(keys.alias("k"))
    assert _hot(rows_, key_sketches(rows_, [["k"]]), "k", min_rows=1) == {0, 1, 2}


def test_spread_rank_equals_window(spark):
    values = (
        "(null), (0), (0), (-0.01), (-123456789.12), (0.01), (9999.99), (10000.00), (10000.01), "
        "(1000000.00), (99999999.99), (10000000000.00), (20000000000.00), (20000000000.01), "
        "(90000000000000.00), (90000000000000.00), (123.45)"
    )
    df = spark.sql(f"select cast(v as decimal(22,2)) v from values {values} t(v)")
    df = df.join(spark.sql("select explode(array('a', 'b', null)) g"), how="cross")
    df = df.withColumn("id", F.monotonically_increasing_id()).where("g is null or id % 3 > 0").cache()
    by_window = F.dense_rank().over(W.partitionBy("g").orderBy(F.col("v").desc_nulls_last()))
    expected = rows(df.withColumn("r", by_window))
    for parts in (None, 1, 3, 40):
        assert rows(dense_rank_spread(df, "v", {"r": ["g"]}, parts)) == expected


def test_spread_rank_of_many_values(spark):
    df = spark.range(20_000).select(
        "id",
        (F.col("id") % 3).alias("g"),
        (F.pmod(F.hash("id"), F.lit(2_000_000_000)) / 100).cast("decimal(22,2)").alias("v"),
    )
    by_window = F.dense_rank().over(W.partitionBy("g").orderBy(F.col("v").desc()))
    overall = F.dense_rank().over(W.orderBy(F.col("v").desc()))
    expected = df.withColumn("r", by_window).withColumn("o", overall)
    for parts in (None, 16):
        spread = dense_rank_spread(df.withColumn("one", F.lit(1)), "v", {"r": ["g"], "o": ["one"]}, parts)
        assert rows(spread.drop("one")) == rows(expected)


def test_spread_rank_of_ties_over_parts(spark):
    """Two thirds of the rows of a month have one revenue, or none, and lie in several parts."""
    df = spark.range(6_000).select(
        "id",
        F.lit(1).alias("month"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 4).alias("category"),
        F.expr("case when id % 3 = 0 then 500 when id % 3 = 2 then id % 1000 end").cast("decimal(22,2)").alias("v"),
    )
    ranks = {"o": ["month"], "r": ["month", "category"]}
    expected = df
    for out, groups in ranks.items():
        by_window = F.dense_rank().over(W.partitionBy(*groups).orderBy(F.col("v").desc_nulls_last()))
        expected = expected.withColumn(out, by_window)
    for parts in (2, 12):
        assert rows(dense_rank_spread(df, "v", ranks, parts)) == rows(expected)


def test_parts_of_a_spread_rank_are_balanced(spark, monkeypatch):
    kept = []
    monkeypatch.setattr("qcmart.operators.ranking.cut", lambda df: kept.append(cut(df)) or kept[0])
    df = spark.range(12_000).select("id", F.lit(1).alias("g"), F.lit(None).cast("decimal(22,2)").alias("v"))
    dense_rank_spread(df, "v", {"r": ["g"]}, 12)
    sizes = [r["count"] for r in kept[0].groupBy("__part").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 2_000


def test_both_ranks_share_one_exchange(spark, monkeypatch):
    kept = []
    monkeypatch.setattr("qcmart.operators.ranking.cut", lambda df: kept.append(plan(df)) or cut(df))
    df = spark.range(100).select("id", F.lit(1).alias("g"), (F.col("id") % 3).alias("c"), F.col("id").alias("v"))
    dense_rank_spread(df, "v", {"r": ["g", "c"], "o": ["g"]}, 4)
    assert kept[0].count("Exchange rangepartitioning") == kept[0].count("Exchange hashpartitioning") == 1


def test_facts_over_large_inputs(spark):
    models = entry._models(spark, "/root/testdata/sf0.001")
    dims = (models.dim_customers, models.dim_stores, models.dim_date)
    orders = facts.fct_orders(models.stg_orders, *dims, **LARGE)
    assert rows(orders) == rows(models.fct_orders)
    lines = (models.stg_order_items, models.fct_orders, models.dim_products)
    assert rows(facts.fct_order_items(*lines, **LARGE)) == rows(models.fct_order_items)


def test_kept_sketches_spare_a_pass_over_the_facts(spark, tmp_path):
    """With bounds that make every input count as large, each fact is read once."""
    models = entry._models(spark, "/root/testdata/sf0.001")
    for name in ("stg_orders", "stg_order_items", "fct_orders"):
        models[name].write.parquet(str(tmp_path / name))
    stored = {n: spark.read.parquet(str(tmp_path / n)) for n in ("stg_orders", "stg_order_items", "fct_orders")}
    kept = {}
    for name, keys in (("stg_orders", facts.ORDER_REFERENCES), ("stg_order_items", facts.LINE_REFERENCES)):
        key_sketches(stored[name], keys).write.parquet(str(tmp_path / f"{name}_sketches"))
        kept[name] = spark.read.parquet(str(tmp_path / f"{name}_sketches"))
    dims = (models.dim_customers, models.dim_stores, models.dim_date)
    for sketches, scans in ((kept["stg_orders"], 1), (None, 2)):
        orders = facts.fct_orders(stored["stg_orders"], *dims, sketches, **LARGE)
        assert rows(orders) == rows(models.fct_orders)
        assert scanned(orders, "stg_orders") == scans
    for sketches, scans in ((kept["stg_order_items"], 1), (None, 2)):
        args = (stored["stg_order_items"], stored["fct_orders"], models.dim_products, sketches)
        lines = facts.fct_order_items(*args, **LARGE)
        assert rows(lines) == rows(models.fct_order_items)
        assert scanned(lines, "stg_order_items") == scans


def scanned(df, folder) -> int:
    """How many scans of files below a folder ran for all rows of ``df``."""
    with settings(df.sparkSession, **{"spark.sql.maxMetadataStringLength": "2000"}):
        df = df.select("*")
        df.collect()
        tree = df._jdf.queryExecution().executedPlan().toString()
    final = tree.split("== Initial Plan ==")[0]
    return sum(f"/{folder}]" in line for line in set(re.findall(r"FileScan parquet .*", final)))


def test_rankings_of_a_large_product_dimension(spark):
    sf_dir = "/root/testdata/sf0.001"
    models = entry._models(spark, sf_dir)
    args = (models.fct_order_items, models.dim_products, models.dim_date)
    ranked = marts.mart_product_rankings(*args)
    by_window = W.partitionBy("year", "month").orderBy(F.col("total_revenue").desc_nulls_last())
    expected = rows(ranked.withColumn("overall_rank", F.dense_rank().over(by_window).cast("bigint")))
    assert rows(ranked) == expected
    assert rows(marts.mart_product_rankings(*args, parts=9)) == expected
    assert "lineitem" not in plan(ranked)


def test_spread_rank_of_huge_and_missing_values(spark):
    values = "(92233720368547759.00), (92233720368547759.00), (92233720368547758.99), (-92233720368547759.00), (null)"
    df = spark.sql(f"select 1 g, cast(v as decimal(22,2)) v from values {values} t(v)")
    by_window = F.dense_rank().over(W.partitionBy("g").orderBy(F.col("v").desc_nulls_last()))
    expected = rows(df.withColumn("r", by_window))
    for parts in (None, 1, 3, 40):
        assert rows(dense_rank_spread(df, "v", {"r": ["g"]}, parts)) == expected


def test_lineage_is_cut_in_the_named_folder(spark):
    df = spark.range(10).groupBy((F.col("id") % 2).alias("k")).count()
    assert "HashAggregate" in plan(df) and "HashAggregate" not in plan(cut(df))
    named = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    assert all(named in f for f in cut(df).inputFiles())


def test_copies_are_dropped_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 3).cast("string").alias("k"), "id")
    tree = plan(keep_first(df, ["k"], ["id"]))
    assert tree.index("Partial") > tree.index("Exchange hashpartitioning") > tree.index("Final")


def test_input_bytes_bound_the_broadcast(spark):
    lineitem = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    assert input_bytes(lineitem) > 1_000_000
    assert "broadcast" in broadcast_if_small(lineitem)._jdf.queryExecution().logical().toString()
    bounded = broadcast_if_small(lineitem, 1000)
    assert "broadcast" not in bounded._jdf.queryExecution().logical().toString()


@pytest.mark.parametrize("name", list(entry.queries()))
def test_plans_have_no_cross_joins_or_python(spark, name):
    tree = plan(entry.queries()[name](spark, "/root/testdata/sf0.001"))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Exchange RoundRobin"):
        assert bad not in tree


def test_marts_read_only_their_columns(spark, tmp_path):
    models = entry._models(spark, "/root/testdata/sf0.001")
    models.fct_orders.write.parquet(str(tmp_path / "fct_orders"))
    models.use("fct_orders", spark.read.parquet(str(tmp_path / "fct_orders")))
    tree = plan(models.mart_daily_sales)
    scan = next(line for line in tree.splitlines() if "FileScan" in line)
    assert "IsNotNull(date_key)" in scan
    for unused in ("created_at", "store_key", "is_express", "order_hour"):
        assert unused not in scan
