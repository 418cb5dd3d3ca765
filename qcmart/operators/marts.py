"""Aggregate marts over the facts.

Every mart groups by keys first and joins the dimensions to the few grouped rows,
so dimension keys must be unique (the quality rules check it before facts are built).
A grouped row stands for one key and one day or month, so no key is hot any more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qcmart.functions import davg, pct, ratio, sql_round
from qcmart.operators.ranking import dense_rank_spread
from qcmart.operators.sizing import broadcast_if_small

# Presentation order of each mart: (column, descending?).
MART_ORDER = {
    "mart_daily_sales": (("date_day", True), ("city", False)),
    "mart_store_performance": (("date_day", True), ("total_gmv", True)),
    "mart_product_rankings": (("year", False), ("month", False), ("overall_rank", False)),
}


def in_mart_order(mart: DataFrame, name: str) -> DataFrame:
    """Sort a mart for presentation; stored tables carry no order."""
    return mart.orderBy(
        *[
            F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last()
            for c, descending in MART_ORDER[name]
        ]
    )


def _with_status(status: str) -> Column:
    return F.col("status") == status


# The finest grain that the marts of orders are made from.
GRAIN = ("date_key", "order_date", "city", "store_key")
COUNTERS = (
    "total_orders", "delivered_orders", "cancelled_orders", "returned_orders", "late_orders",
    "total_gmv", "net_revenue", "minutes", "timed_orders",
)


def order_counters(orders: DataFrame, grain: Sequence[str] = GRAIN) -> DataFrame:
    """Sums of orders per day, city and store, which add up to those of any coarser grain.

    One row for each ``grain``, however many orders. ``hours`` holds the orders of each hour of the
    day: twenty-four counters keep the aggregate fixed in size and inside code generation.
    """
    delivered = _with_status("delivered")
    minutes = F.when(delivered, F.col("delivery_minutes"))
    revenue = F.when(delivered, F.col("total_amount")).otherwise(0)
    return orders.groupBy(*grain).agg(
        F.count("order_id").alias("total_orders"),
        F.count_if(delivered).alias("delivered_orders"),
        F.count_if(_with_status("cancelled")).alias("cancelled_orders"),
        F.count_if(_with_status("returned")).alias("returned_orders"),
        F.count_if(F.col("is_late")).alias("late_orders"),
        F.sum("total_amount").alias("total_gmv"),
        F.sum(revenue.cast("decimal(12,2)")).alias("net_revenue"),
        F.sum(minutes).alias("minutes"),
        F.count(minutes).alias("timed_orders"),
        F.count("total_amount").alias("priced_orders"),
        F.array(*[F.count_if(F.col("order_hour") == h) for h in range(24)]).alias("hours"),
    )


def order_buyers(orders: DataFrame, grain: Sequence[str] = GRAIN) -> DataFrame:
    """The distinct customers of each day, city and store, of which any coarser grain's are a subset's union."""
    return orders.select(*grain, "customer_key").distinct()


def order_measures(counters: DataFrame, buyers: DataFrame, keys: list[str]) -> DataFrame:
    """All measures of orders by ``keys``, columns of the counters and buyers, added up from daily state."""
    sums = [F.sum(c).alias(c) for c in (*COUNTERS, "priced_orders")]
    hours = [F.sum(F.col("hours")[h]).alias(f"__h{h}") for h in range(24)]
    customers = buyers.select(*keys, "customer_key").distinct()
    customers = customers.groupBy(*keys).agg(F.count("customer_key").alias("unique_customers"))
    # counted apart, or every customer's row of the shuffle would carry all counters
    added = counters.groupBy(*keys).agg(*sums, *hours)
    same = [added[k].eqNullSafe(customers[k]) for k in keys]
    added = added.join(customers, same).drop(*[customers[k] for k in keys])
    hours = F.array(*[F.col(f"__h{h}") for h in range(24)])
    most = F.array_max(hours)
    return added.withColumns(
        {
            "avg_order_value": sql_round(ratio(F.col("total_gmv"), F.col("priced_orders")), 2),
            "avg_delivery_minutes": sql_round(ratio(F.col("minutes"), F.col("timed_orders")), 1),
            "cancelled_pct": pct(F.col("cancelled_orders"), F.col("total_orders")),
            "late_pct": pct(F.col("late_orders"), F.col("delivered_orders")),
            # the most frequent hour, the earliest of equals; NULL when no hour is known
            "peak_hour": F.when(most > 0, F.array_position(hours, most).cast("int") - 1),
        }
    )


def _grouped(df: DataFrame, keys: list[str], measures: dict[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()])


def daily_sales(counters: DataFrame, buyers: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sales per day and order city, from daily state. Orders outside the calendar are left out."""
    counters, buyers = (df.where("date_key is not null") for df in (counters, buyers))
    sales = order_measures(counters, buyers, ["date_key", "city"])
    return sales.join(F.broadcast(calendar), "date_key").select(
        "date_day",
        "year",
        "month",
        "week_of_year",
        "is_weekend",
        "city",
        "total_orders",
        "delivered_orders",
        "cancelled_orders",
        "returned_orders",
        "unique_customers",
        "total_gmv",
        "net_revenue",
        "avg_order_value",
        "avg_delivery_minutes",
        F.col("cancelled_pct").alias("cancellation_rate_pct"),
        F.col("late_pct").alias("late_delivery_rate_pct"),
    )


def mart_daily_sales(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sales per day and order city. Orders outside the calendar are left out."""
    grain = ("date_key", "city")
    return daily_sales(order_counters(orders, grain), order_buyers(orders, grain), calendar)


def store_performance(
    counters: DataFrame, buyers: DataFrame, stores: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Sales per day and store, with the store's own city, from daily state. Orders of unknown
    stores or outside the calendar are left out."""
    known = "date_key is not null and store_key is not null"
    sales = order_measures(counters.where(known), buyers.where(known), ["date_key", "store_key"])
    places = stores.select("store_key", "store_id", "city", "zone", "city_tier")
    sales = sales.join(broadcast_if_small(places), "store_key")
    return sales.join(F.broadcast(calendar), "date_key").select(
        "date_day",
        "store_id",
        "city",
        "zone",
        "city_tier",
        "total_orders",
        "delivered_orders",
        "cancelled_orders",
        "unique_customers",
        "total_gmv",
        "avg_order_value",
        "avg_delivery_minutes",
        "late_pct",
        F.col("cancelled_pct").alias("cancellation_pct"),
        "peak_hour",
    )


def mart_store_performance(
    orders: DataFrame, stores: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Sales per day and store, with the store's own city. Orders of unknown stores
    or outside the calendar are left out."""
    return store_performance(order_counters(orders), order_buyers(orders), stores, calendar)


def monthly_sales(counters: DataFrame, buyers: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sales per month and order city, from daily state: customers of several days count once."""
    months = F.broadcast(calendar.select("date_key", "year", "month"))
    counters, buyers = (df.join(months, "date_key") for df in (counters, buyers))
    keys = ["year", "month", "city"]
    return order_measures(counters, buyers, keys).select(
        *keys,
        *[c for c in COUNTERS if c not in ("minutes", "timed_orders")],
        "unique_customers",
        "avg_order_value",
        "avg_delivery_minutes",
        "cancelled_pct",
        "late_pct",
        "peak_hour",
    )


def mart_product_rankings(
    items: DataFrame,
    products: DataFrame,
    calendar: DataFrame,
    parts: int | None = None,
) -> DataFrame:
    """Delivered sales per month and product, ranked by revenue.

    A rank group holds one row per product. The monthly rows are written once, in ranges of month and
    revenue (of that many parts, if told), and ranked there, however few or many products there are.
    """
    months = F.broadcast(calendar.select("date_key", "year", "month"))
    sold = items.where(_with_status("delivered") & F.col("product_key").isNotNull())
    measures = {
        "orders_containing_product": F.count_distinct("order_id"),
        "total_units_sold": F.sum("qty"),
        "total_revenue": F.sum("line_total"),
        "avg_selling_price": sql_round(davg(F.col("unit_price")), 2),
        "avg_qty_per_order": sql_round(F.avg("qty"), 2),
        "revenue_per_unit": sql_round(ratio(F.sum("line_total"), F.sum("qty")), 2),
    }
    sales = _grouped(
        sold.join(months, "date_key"), ["year", "month", "product_key"], measures
    )
    sales = sales.join(broadcast_if_small(products), "product_key").drop("product_key")
    ranks = {
        "rank_in_category": ["year", "month", "category"],
        "overall_rank": ["year", "month"],
    }
    sales = dense_rank_spread(sales, "total_revenue", ranks, parts)
    return sales.select(
        "year",
        "month",
        "product_id",
        "product_name",
        "category",
        "subcategory",
        "mrp",
        "price_band",
        *measures,
        *ranks,
    )
