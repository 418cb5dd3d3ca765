"""The raw tables derived from the sample tables (regions, nations, customers, ...).

Order days move forward by 28 years, which keeps weekdays and leap years.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qcmart.operators.cleaning import keep_first
from qcmart.operators.facts import LINE_REFERENCES, ORDER_REFERENCES
from qcmart.operators.joins import lookup
from qcmart.operators.sizing import ONE_TASK_BYTES, input_bytes
from qcmart.operators.sketches import hot_among, key_sketches
from qcmart.sources.schemas import RAW_ORDER_ITEMS, RAW_ORDERS

# Rows of one order line are told apart by these columns.
LINE_ORDER = (
    "l_partkey",
    "l_suppkey",
    "l_shipdate",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
)

SAMPLE_TIER_1 = tuple(f"NATION_{n}" for n in range(6))


# Given layouts spare the look into file footers that inference needs.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def text_id(prefix: str, key: str, width: int = 8) -> Column:
    """Zero-padded id; a key longer than ``width`` keeps all its digits."""
    limit = 10**width
    padded = F.substr((F.col(key) + limit).cast("string"), F.lit(2))
    digits = F.when(F.col(key) < limit, padded).otherwise(F.col(key).cast("string"))
    return F.concat(F.lit(prefix), digits)


def _nations(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Nation and region names under the given key name; 25 rows."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias(key), "n_name", "n_regionkey", "r_name"
    )


def _moved(day: str) -> Column:
    return F.col(day).cast("timestamp_ntz") + F.expr("interval 28 years")


def raw_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), "n_name"
    )
    return supplier.join(nation, "s_nationkey").select(
        text_id("DS", "s_suppkey", 6).alias("store_id"),
        F.col("n_name").alias("city"),
        F.col("s_name").alias("zone"),
        (F.col("s_nationkey") + 8.0).alias("lat"),
        (F.col("s_nationkey") + 70.0).alias("lon"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        text_id("P", "p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        (F.col("p_size") * 20).cast("double").alias("mrp"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    signup = F.expr("date_add(date '2023-01-01', cast(c_custkey * 11 % 730 as int))")
    return customer.join(_nations(spark, sf_dir, "c_nationkey"), "c_nationkey").select(
        text_id("C", "c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.lit(None).cast("string").alias("phone"),
        F.col("n_name").alias("city"),
        F.when(F.col("n_regionkey").isin(0, 1), 1).otherwise(2).alias("tier"),
        F.col("r_name").alias("state"),
        signup.alias("signup_date"),
    )


def _keyed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders with the number behind their id as ``key``."""
    stores = raw_stores(spark, sf_dir).select("store_id", "city")
    n_stores = table(spark, sf_dir, "supplier").count()
    time_of_day = F.expr(
        "make_dt_interval(0, cast(o_orderkey * 7 % 24 as int), cast(o_orderkey * 13 % 60 as int), 0)"
    )
    fulfilled = F.col("o_orderstatus") == "F"
    minutes = (F.col("o_orderkey") % 28 + 8).cast("int")
    orders = (
        table(spark, sf_dir, "orders")
        .withColumn("__store", F.col("o_orderkey") % n_stores)
        .select(
            F.col("o_orderkey").alias("key"),
            text_id("ORD", "o_orderkey").alias("order_id"),
            text_id("C", "o_custkey").alias("customer_id"),
            text_id("DS", "__store", 6).alias("store_id"),
            (_moved("o_orderdate") + time_of_day).alias("created_at"),
            F.when(fulfilled, "delivered")
            .when(F.col("o_orderstatus") == "O", "cancelled")
            .otherwise("returned")
            .alias("status"),
            F.col("o_totalprice").alias("total_amount"),
            F.when(fulfilled, minutes).alias("delivery_minutes"),
            (fulfilled & (minutes > 25)).alias("is_late"),
            _moved("o_orderdate").cast("date").alias("date"),
        )
    )
    placed = lookup(orders, stores.withColumn("__known", F.lit(True)), ["store_id"])
    return placed.where("__known").drop("__known")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed_orders(spark, sf_dir).select(*RAW_ORDERS.names)


def _hot_orders(spark: SparkSession, sf_dir: str) -> list[int]:
    """The orders with so many lines that their rows must not meet in one task."""
    lineitem = table(spark, sf_dir, "lineitem")
    if input_bytes(lineitem) <= ONE_TASK_BYTES:
        return []
    return hot_among(key_sketches(lineitem, [["l_orderkey"]]), ["l_orderkey"])


def sketches(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Sketches of the keys by which raw orders or order lines refer to others, from one scan of the table
    behind them. The rows that the raw tables leave out are sketched too."""
    if name == "raw_orders":
        n_stores = table(spark, sf_dir, "supplier").count()
        orders = table(spark, sf_dir, "orders").withColumn("__store", F.col("o_orderkey") % n_stores)
        ids = [text_id("C", "o_custkey").alias("customer_id"), text_id("DS", "__store", 6).alias("store_id")]
        return key_sketches(orders.select(*ids), ORDER_REFERENCES)
    ids = [text_id("ORD", "l_orderkey").alias("order_id"), text_id("P", "l_partkey").alias("product_id")]
    return key_sketches(table(spark, sf_dir, "lineitem").select(*ids), LINE_REFERENCES)


def _order_lines(
    spark: SparkSession, sf_dir: str, lineitem: DataFrame, hot: list[int] | None = None
) -> DataFrame:
    """Order lines with the numbers behind their id as ``key`` and LINE_ORDER. ``hot``: _hot_orders(). Lines
    that have their ``order_id`` already are joined by it, and so stay where it put them."""
    by = "order_id" if "order_id" in lineitem.columns else "l_orderkey"
    days = table(spark, sf_dir, "orders").select(
        *([text_id("ORD", "o_orderkey").alias(by)] if by == "order_id" else []),
        F.col("o_orderkey").alias("__order" if by == "order_id" else by),
        _moved("o_orderdate").cast("date").alias("date"),
        F.lit(True).alias("__known"),
    )
    # lines without an order are left out below
    lines = lookup(
        lineitem.where("l_orderkey is not null"),
        days,
        [by],
        hot=_hot_orders(spark, sf_dir) if hot is None else hot,
        spread_by=["l_linenumber", "l_partkey"],
        all_keyed=True,
    ).where("__known")
    if by == "order_id":
        # ids of odd numbers may clash; an equality would join, and shuffle, by the numbers too
        lines = lines.where("l_orderkey >= __order and l_orderkey <= __order")
    else:
        lines = lines.withColumn("order_id", text_id("ORD", "l_orderkey"))
    line = F.col("l_linenumber").cast("string")
    price = F.round(F.col("l_extendedprice") / F.col("l_quantity") * 100) / 100
    return lines.select(
        F.concat(text_id("OI", "l_orderkey"), F.lit("-"), line).alias("order_item_id"),
        "order_id",
        text_id("P", "l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("qty"),
        price.alias("unit_price"),
        F.col("l_extendedprice").alias("line_total"),
        "date",
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key"),
        *LINE_ORDER,
    )


def raw_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines before deduplication, with the columns that order the copies."""
    return _order_lines(spark, sf_dir, table(spark, sf_dir, "lineitem")).drop("key")


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the first copy of each.

    Unless an order is hot, lines are shuffled once, by ``order_id``, to find first copies and the order's day, and
    whatever joins them by it later.
    """
    lineitem = table(spark, sf_dir, "lineitem").where("l_orderkey is not null")
    hot = _hot_orders(spark, sf_dir)
    keys = ["l_orderkey", "l_linenumber"]
    if not hot:
        lineitem = lineitem.withColumn("order_id", text_id("ORD", "l_orderkey")).repartition("order_id")
        keys.insert(0, "order_id")
    # copies that are equal up to the price give the same order line, whatever discount and tax
    decisive = LINE_ORDER[: LINE_ORDER.index("l_extendedprice") + 1]
    first = keep_first(lineitem, keys, decisive)
    return _order_lines(spark, sf_dir, first, hot).drop("key", *LINE_ORDER)


def _planted(key: str, every: int, value: Column, otherwise: Column) -> Column:
    return F.when(F.col(key) % every == 0, value).otherwise(otherwise)


def raw_order_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as untrusted text: every order twice, and unreadable values throughout.

    ``key`` and ``copy`` give the order of the rows in the file.
    """
    text = _keyed_orders(spark, sf_dir).select(
        "key", *[F.col(c).cast("string").alias(c) for c in RAW_ORDERS.names]
    )
    nothing, blank = F.lit(None).cast("string"), F.lit("")
    created = _planted("key", 103, blank, F.col("created_at"))
    total = _planted("key", 89, blank, F.col("total_amount"))
    total = _planted("key", 71, F.lit("-5.00"), total)
    late = _planted("key", 79, blank, F.col("is_late"))
    status = _planted("key", 67, F.concat(F.lit(" "), F.upper("status")), F.col("status"))
    planted = text.withColumns(
        {
            "order_id": _planted("key", 211, nothing, F.col("order_id")),
            "customer_id": _planted("key", 107, F.lit("NA"), F.col("customer_id")),
            "created_at": _planted("key", 101, F.lit("not a time"), created),
            "status": status,
            "total_amount": _planted("key", 97, F.lit("abc"), total),
            "delivery_minutes": _planted(
                "key", 83, F.lit("soon"), F.col("delivery_minutes")
            ),
            "is_late": _planted("key", 73, F.lit("maybe"), late),
        }
    )
    copies = planted.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    lost = F.when(F.col("copy") == 1, "lost").otherwise(F.col("status"))
    return copies.withColumn("status", lost)


def raw_order_line_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as untrusted text, with all their copies and unreadable, infinite, too
    large and fractional values throughout. LINE_ORDER gives the order of the copies."""
    lines = _order_lines(spark, sf_dir, table(spark, sf_dir, "lineitem"))
    text = lines.withColumns({c: F.col(c).cast("string") for c in RAW_ORDER_ITEMS.names})
    qty = _planted("key", 101, F.lit("abc"), F.col("qty"))
    qty = _planted("key", 103, F.lit(""), qty)
    qty = _planted("key", 89, F.lit("inf"), qty)
    qty = _planted("key", 83, F.lit("99999999999"), qty)
    price = _planted("key", 73, F.lit(""), F.col("unit_price"))
    total = _planted("key", 67, F.lit("12f"), F.col("line_total"))
    return text.withColumns(
        {
            "order_item_id": _planted("key", 211, F.lit(None).cast("string"), F.col("order_item_id")),
            "product_id": _planted("key", 107, F.lit("NA"), F.col("product_id")),
            "qty": _planted("key", 97, F.concat("qty", F.lit(".5")), qty),
            "unit_price": _planted("key", 79, F.lit("Infinity"), price),
            "line_total": _planted("key", 71, F.lit("NaN"), total),
        }
    )
