"""How often, and how wide, order lines are shuffled on their way into the facts."""

from __future__ import annotations

from functools import partial

import pytest
from pyspark.sql import functions as F

from qcmart.operators import facts, staging
from qcmart.operators.joins import lookup
from qcmart.operators.sketches import key_sketches
from qcmart.sources import samples
from tests.test_scale import plan, rows, settings

# Bounds that make every input count as large; no key is hot.
LARGE = {"broadcast_bytes": 0, "one_task_bytes": 0}
SHUFFLED = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Raw tables of their own: lines with copies, without order and without any key."""
    folder = str(tmp_path_factory.mktemp("raw"))
    orders = spark.range(300).selectExpr(
        "id o_orderkey", "id % 40 o_custkey", "'F' o_orderstatus", "id + 0.5d o_totalprice",
        "timestamp_ntz '1996-03-01' + make_dt_interval(cast(id % 60 as int)) o_orderdate", "'x' o_orderpriority",
    )
    lines = spark.range(2000).selectExpr(
        "case when id % 50 = 7 then null else id % 310 end l_orderkey", "id % 30 l_partkey", "id % 5 l_suppkey",
        "cast(id % 3 as int) l_linenumber", "id % 9 + 1d l_quantity", "id % 700 + 0.25d l_extendedprice",
        "0d l_discount", "id % 2 + 0d l_tax", "'N' l_returnflag", "'O' l_linestatus",
        "timestamp_ntz '1996-04-01' l_shipdate",
    )
    orders.write.parquet(f"{folder}/orders.parquet")
    lines.write.parquet(f"{folder}/lineitem.parquet")
    return folder


def _facts(spark):
    items = spark.range(500).selectExpr(
        "concat('I', id) order_item_id", "concat('O', id % 90) order_id",
        "if(id % 11 = 0, null, concat('P', id % 40)) product_id", "1 qty", "cast(2 as decimal(10,2)) unit_price",
        "cast(id as decimal(12,2)) line_total", "date '2024-01-01' order_date",
    )
    orders = spark.range(80).selectExpr(
        "concat('O', id) order_id", "20240101 date_key", "concat('c', id) customer_key", "concat('s', id) store_key",
        "'X' city", "'delivered' status",
    )
    products = spark.range(35).selectExpr("concat('P', id) product_id", "concat('p', id) product_key")
    return items, orders, products


def test_lookup_without_hot_keys(spark):
    items, orders, _ = _facts(spark)
    items = items.withColumn("order_id", F.when(F.col("qty") % 7 > 0, F.col("order_id")))
    expected = rows(items.join(orders, ["order_id"], "left"))
    sketches = key_sketches(items, [["order_id"]])
    spread = lookup(items, orders, ["order_id"], sketches, kept=True, spread_by=["order_item_id"], **LARGE)
    assert rows(spread) == expected
    with settings(spark, **SHUFFLED):
        kept = lookup(items, orders, ["order_id"], sketches, kept=True, all_keyed=True, **LARGE)
        assert rows(kept) == expected
        assert "__slot" in plan(spread) and "__slot" not in plan(kept)
    # the search for hot keys does not read the table a second time
    assert plan(spread).count("Range (0, 80") == plan(kept).count("Range (0, 80") == 1


def test_checks_of_one_column_shuffle_only_keys(spark, tmp_path):
    """dq_not_null: columns of the lines that nothing asks for stay unread."""
    items, orders, products = _facts(spark)
    items.write.parquet(str(tmp_path / "items"))
    items = spark.read.parquet(str(tmp_path / "items"))
    with settings(spark, **SHUFFLED):
        lines = facts.fct_order_items(items, orders, products, **LARGE).select("order_item_id")
        assert "line_total" not in plan(lines) and "customer_key" not in plan(lines)
        assert lines.count() == 500


def test_lines_of_an_order_stay_together(spark):
    """mart_product_rankings: counting distinct orders needs no shuffle by order of its own."""
    items, orders, products = _facts(spark)
    sketches = key_sketches(items, facts.LINE_REFERENCES)
    expected = items.join(orders, ["order_id"], "left").join(products, ["product_id"], "left")
    with settings(spark, **SHUFFLED):
        lines = facts.fct_order_items(items, orders, products, sketches, **LARGE)
        counts = F.count_distinct("order_id").alias("n"), F.sum("qty").alias("units")
        counted = lines.groupBy("product_key").agg(*counts)
        shuffles = [x for x in plan(counted).splitlines() if "Exchange hash" in x]
        assert len(shuffles) == 5 and not any("product_key" in x and "order_id" in x for x in shuffles)
        assert rows(counted) == rows(expected.groupBy("product_key").agg(*counts))


def test_raw_lines_are_shuffled_once(spark, tables, monkeypatch):
    """fct_order_items: first copies and the order's day are found in one shuffle of the lines."""
    expected = rows(samples.raw_order_items(spark, tables))
    monkeypatch.setattr(samples, "lookup", partial(lookup, **LARGE))
    monkeypatch.setattr(samples, "ONE_TASK_BYTES", 0)
    with settings(spark, **SHUFFLED):
        items = samples.raw_order_items(spark, tables)
        assert plan(items).count("Exchange hash") == 2
        assert rows(items) == expected


def test_first_copies_of_hot_orders(spark, tables, monkeypatch):
    """With hot orders the lines go the balanced way, and are the same."""
    expected = rows(samples.raw_order_items(spark, tables))
    monkeypatch.setattr(samples, "lookup", partial(lookup, **LARGE))
    monkeypatch.setattr(samples, "ONE_TASK_BYTES", 0)
    monkeypatch.setattr(samples, "hot_among", lambda sketches, key: [r[0] for r in spark.range(9).selectExpr(
        "shiftrightunsigned(xxhash64(id), 1)").collect()])
    assert rows(samples.raw_order_items(spark, tables)) == expected
    assert samples.raw_order_lines(spark, tables).count() > len(expected) > 0


def test_sample_sketches_count_all_keys(spark, tables):
    spark.range(1, 8).selectExpr("id s_suppkey", "'n' s_name", "1 s_nationkey", "0d s_acctbal").write.parquet(
        f"{tables}/supplier.parquet"
    )
    found = {r.key: r.key_rows for n in ("raw_orders", "raw_order_items") for r in samples.sketches(spark, tables, n).collect()}
    assert found == {"customer_id": 300, "store_id": 300, "order_id": 1960, "product_id": 2000}


def test_lines_meet_their_order_where_they_lie(spark, tables, monkeypatch):
    """mart_product_rankings: lines that were shuffled for first copies are not shuffled for their order again."""
    _, orders, products = _facts(spark)
    orders = orders.withColumn("order_id", F.concat(F.lit("ORD"), F.lpad(F.substring("order_id", 2, 9), 8, "0")))
    products = products.withColumn("product_id", F.concat(F.lit("P"), F.lpad(F.substring("product_id", 2, 9), 8, "0")))
    items = staging.stg_order_items(samples.raw_order_items(spark, tables))
    expected = rows(facts.fct_order_items(items, orders, products))
    assert sum(r["status"] is not None for r in facts.fct_order_items(items, orders, products).collect()) > 100
    monkeypatch.setattr(samples, "lookup", partial(lookup, **LARGE))
    monkeypatch.setattr(samples, "ONE_TASK_BYTES", 0)
    with settings(spark, **SHUFFLED):
        items = staging.stg_order_items(samples.raw_order_items(spark, tables))
        sketches = samples.sketches(spark, tables, "raw_order_items")
        lines = facts.fct_order_items(items, orders, products, sketches, by_order=True, **LARGE)
        # lines, days and orders by order; lines and products by product
        assert plan(lines).count("Exchange hash") == 5
        assert rows(lines) == expected


def test_days_of_clashing_ids(spark, tmp_path):
    """Lines are shuffled by order id; orders of the same id, as of odd numbers, still keep to their own lines."""
    keys = "case id when 0 then -100000000 when 1 then -99999999 else id end"
    spark.range(40).selectExpr(
        f"{keys} o_orderkey", "1L o_custkey", "'F' o_orderstatus", "1d o_totalprice",
        "timestamp_ntz '1996-03-01' + make_dt_interval(cast(id as int)) o_orderdate", "'x' o_orderpriority",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(40).selectExpr(
        f"{keys} l_orderkey", "id l_partkey", "1L l_suppkey", "1 l_linenumber", "2d l_quantity", "3d l_extendedprice",
        "0d l_discount", "0d l_tax", "'N' l_returnflag", "'O' l_linestatus", "timestamp_ntz '1996-04-01' l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    every = samples.raw_order_lines(spark, str(tmp_path)).drop(*samples.LINE_ORDER)
    assert rows(samples.raw_order_items(spark, str(tmp_path))) == rows(every)
    assert every.count() == 40 and every.select("order_id").distinct().count() == 39
