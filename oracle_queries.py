"""DuckDB SQL giving the expected result of every registered query.

Written against the sample tables and independently of the Spark code. Money leaves
as double and counts as bigint on both sides.
"""

from __future__ import annotations

import re

# Building blocks, each may use those before it.
BLOCKS: dict[str, str] = {
    "raw_stores": """
        select 'DS' || lpad(s_suppkey::varchar, greatest(6, length(s_suppkey::varchar))::int, '0') as store_id,
               n_name as city, s_name as zone,
               (8.0 + s_nationkey)::double as lat, (70.0 + s_nationkey)::double as lon
        from supplier join nation on n_nationkey = s_nationkey""",
    "raw_products": """
        select 'P' || lpad(p_partkey::varchar, greatest(8, length(p_partkey::varchar))::int, '0') as product_id,
               p_name as name, p_type as category, p_brand as subcategory,
               (p_size * 20)::double as mrp
        from part""",
    "raw_customers": """
        select 'C' || lpad(c_custkey::varchar, greatest(8, length(c_custkey::varchar))::int, '0') as customer_id,
               c_name as name, null::varchar as phone, n_name as city,
               if(n_regionkey in (0, 1), 1, 2) as tier, r_name as state,
               date '2023-01-01' + (c_custkey * 11 % 730)::integer as signup_date
        from customer
        join nation on n_nationkey = c_nationkey
        join region on r_regionkey = n_regionkey""",
    "raw_orders": """
        select 'ORD' || lpad(o_orderkey::varchar, greatest(8, length(o_orderkey::varchar))::int, '0') as order_id,
               'C' || lpad(o_custkey::varchar, greatest(8, length(o_custkey::varchar))::int, '0') as customer_id,
               s.store_id, s.city,
               o_orderdate::timestamp + interval 28 year
                   + to_hours((o_orderkey * 7) % 24) + to_minutes((o_orderkey * 13) % 60) as created_at,
               case o_orderstatus when 'F' then 'delivered' when 'O' then 'cancelled' else 'returned' end as status,
               o_totalprice as total_amount,
               if(o_orderstatus = 'F', (8 + o_orderkey % 28)::integer, null) as delivery_minutes,
               o_orderstatus = 'F' and 8 + o_orderkey % 28 > 25 as is_late,
               (o_orderdate::timestamp + interval 28 year)::date as date
        from orders
        cross join (select count(*) as n from supplier) size
        join raw_stores s
          on s.store_id = 'DS' || lpad((o_orderkey % size.n)::varchar,
                                       greatest(6, length((o_orderkey % size.n)::varchar))::int, '0')""",
    "order_lines": """
        select 'OI' || lpad(l_orderkey::varchar, greatest(8, length(l_orderkey::varchar))::int, '0')
                   || '-' || l_linenumber as order_item_id,
               'ORD' || lpad(l_orderkey::varchar, greatest(8, length(l_orderkey::varchar))::int, '0') as order_id,
               'P' || lpad(l_partkey::varchar, greatest(8, length(l_partkey::varchar))::int, '0') as product_id,
               l_quantity::integer as qty,
               round(l_extendedprice / l_quantity * 100) / 100 as unit_price,
               l_extendedprice as line_total,
               (o_orderdate::timestamp + interval 28 year)::date as date,
               row_number() over (
                   partition by l_orderkey, l_linenumber
                   order by l_partkey, l_suppkey, l_shipdate, l_quantity,
                            l_extendedprice, l_discount, l_tax) as copy
        from lineitem join orders on o_orderkey = l_orderkey""",
    "raw_order_items": "select * exclude (copy) from order_lines where copy = 1",
    "order_text": """
        select key, copy,
               if(key % 211 = 0, null, order_id) as order_id,
               if(key % 107 = 0, null, customer_id) as customer_id,
               store_id, city,
               case when key % 101 = 0 then 'not a time' when key % 103 = 0 then ''
                    else created_at::varchar end as created_at,
               case when copy = 1 then 'lost' when key % 67 = 0 then ' ' || upper(status)
                    else status end as status,
               case when key % 97 = 0 then 'abc' when key % 71 = 0 then '-5.00'
                    when key % 89 = 0 then '' else total_amount::varchar end as total_amount,
               case when key % 83 = 0 then 'soon' else delivery_minutes::varchar end as delivery_minutes,
               case when key % 73 = 0 then 'maybe' when key % 79 = 0 then ''
                    else is_late::varchar end as is_late,
               date
        from (select *, substr(order_id, 4)::bigint as key from raw_orders)
        cross join (values (0), (1)) copies (copy)""",
    "typed_orders": """
        select order_id, customer_id, store_id, city,
               try_cast(created_at as timestamp) as created_at, status,
               case when isfinite(try_cast(total_amount as double)) then try_cast(total_amount as double)
               end as total_amount,
               try_cast(delivery_minutes as integer) as delivery_minutes,
               coalesce(try_cast(is_late as boolean), true) as is_late, date, key, copy
        from order_text""",
    "line_text": """
        select case when key % 211 <> 0 then order_item_id end as order_item_id, order_id,
               case when key % 107 = 0 then 'NA' else product_id end as product_id,
               case when key % 97 = 0 then qty::varchar || '.5'
                    when key % 83 = 0 then '99999999999' when key % 89 = 0 then 'inf'
                    when key % 103 = 0 then '' when key % 101 = 0 then 'abc'
                    else qty::varchar end as qty,
               case when key % 79 = 0 then 'Infinity' when key % 73 = 0 then ''
                    else unit_price::varchar end as unit_price,
               case when key % 71 = 0 then 'NaN' when key % 67 = 0 then '12f'
                    else line_total::varchar end as line_total,
               date, copy
        from (select *, substr(order_id, 4)::bigint * 10
                        + split_part(order_item_id, '-', 2)::bigint as key
              from order_lines)""",
    "typed_lines": """
        select order_item_id, order_id, nullif(product_id, 'NA') as product_id, qty as qty_text,
               case when isfinite(try_cast(qty as double)) then try_cast(qty as double) end as qty,
               case when isfinite(try_cast(unit_price as double))
                    then try_cast(unit_price as double) end as unit_price,
               case when isfinite(try_cast(line_total as double))
                    then try_cast(line_total as double) end as line_total,
               product_id as product_text, date, copy
        from line_text""",
    "stg_orders": """
        select order_id, customer_id, store_id, city, created_at, date as order_date,
               lower(trim(status)) as status, total_amount::decimal(12, 2) as total_amount,
               delivery_minutes, is_late, hour(created_at) as order_hour,
               dayofweek(created_at) as order_dow,
               coalesce(dayofweek(created_at) in (0, 6), false) as is_weekend
        from raw_orders
        where order_id is not null and customer_id is not null and total_amount > 0""",
    "stg_order_items": """
        select order_item_id, order_id, product_id, qty,
               unit_price::decimal(10, 2) as unit_price,
               line_total::decimal(12, 2) as line_total, date as order_date
        from raw_order_items
        where order_item_id is not null and order_id is not null and qty > 0""",
    "stg_products": """
        select product_id, trim(name) as product_name, trim(category) as category,
               trim(subcategory) as subcategory, mrp::decimal(10, 2) as mrp,
               case when mrp >= 500 or mrp is null then 'Luxury' when mrp >= 150 then 'Premium'
                    when mrp >= 50 then 'Mid-range' else 'Budget' end as price_band
        from raw_products where product_id is not null""",
    "stg_customers": """
        select customer_id, trim(name) as customer_name, trim(city) as city,
               trim(state) as state, tier as city_tier, signup_date,
               date_diff('day', signup_date, date '2024-12-31') as customer_age_days
        from raw_customers where customer_id is not null""",
    "stg_stores": """
        select store_id, trim(city) as city, trim(zone) as zone, lat as latitude, lon as longitude
        from raw_stores where store_id is not null""",
    "dim_customers": """
        select md5(customer_id) as customer_key, *,
               case when customer_age_days >= 365 or customer_age_days is null then 'Loyal'
                    when customer_age_days >= 180 then 'Established'
                    when customer_age_days >= 30 then 'Growing' else 'New' end as customer_segment
        from stg_customers""",
    "dim_products": "select md5(product_id) as product_key, * from stg_products",
    "dim_stores": """
        select md5(store_id) as store_key, *,
               if(city in ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3', 'NATION_4', 'NATION_5'),
                  1, 2) as city_tier
        from stg_stores""",
    "dim_date": """
        select strftime(d, '%Y%m%d')::integer as date_key, d as date_day,
               year(d) as year, month(d) as month, day(d) as day, week(d) as week_of_year,
               quarter(d) as quarter, monthname(d) as month_name, dayname(d) as day_name,
               dayofweek(d) as day_of_week, dayofweek(d) in (0, 6) as is_weekend,
               strftime(d, '%m-%d') in
                   ('01-26', '08-15', '10-02', '10-24', '11-01', '12-25') as is_holiday,
               date_trunc('month', d)::date as month_start, last_day(d) as month_end
        from (select (date '2020-01-01' + i::integer)::date as d from range(2557) r (i))""",
    "fct_orders": """
        select order_id, date_key, customer_key, store_key, o.city, status, total_amount,
               delivery_minutes, is_late, order_hour, order_dow, o.is_weekend, created_at, order_date,
               (status = 'delivered')::integer as is_delivered,
               (status = 'cancelled')::integer as is_cancelled,
               (status = 'returned')::integer as is_returned,
               coalesce(status = 'delivered' and delivery_minutes <= 15, false)::integer as is_express
        from stg_orders o
        left join dim_customers using (customer_id)
        left join dim_stores using (store_id)
        left join dim_date on date_day = order_date""",
    "fct_order_items": """
        select order_item_id, i.order_id, date_key, customer_key, store_key, product_key,
               o.city, status, qty, unit_price, line_total, i.order_date,
               round(line_total / qty, 2) as effective_unit_price
        from stg_order_items i
        left join fct_orders o on o.order_id = i.order_id
        left join dim_products p on p.product_id = i.product_id""",
    "mart_daily_sales": """
        select date_day, year, month, week_of_year, d.is_weekend, city,
               count(*) as total_orders,
               sum(is_delivered) as delivered_orders,
               sum(is_cancelled) as cancelled_orders,
               sum(is_returned) as returned_orders,
               count(distinct customer_key) as unique_customers,
               sum(total_amount) as total_gmv,
               coalesce(sum(total_amount) filter (status = 'delivered'), 0) as net_revenue,
               round(avg(total_amount), 2) as avg_order_value,
               round(avg(delivery_minutes) filter (status = 'delivered'), 1) as avg_delivery_minutes,
               round(100.0 * sum(is_cancelled) / count(*), 2) as cancellation_rate_pct,
               round(100.0 * count(*) filter (is_late) / nullif(sum(is_delivered), 0), 2)
                   as late_delivery_rate_pct
        from fct_orders join dim_date d using (date_key)
        group by date_day, year, month, week_of_year, d.is_weekend, city""",
    "mart_store_performance": """
        select date_day, store_id, s.city, zone, city_tier,
               count(*) as total_orders,
               sum(is_delivered) as delivered_orders,
               sum(is_cancelled) as cancelled_orders,
               count(distinct customer_key) as unique_customers,
               sum(total_amount) as total_gmv,
               round(avg(total_amount), 2) as avg_order_value,
               round(avg(delivery_minutes) filter (status = 'delivered'), 1) as avg_delivery_minutes,
               round(100.0 * count(*) filter (is_late) / nullif(sum(is_delivered), 0), 2) as late_pct,
               round(100.0 * sum(is_cancelled) / count(*), 2) as cancellation_pct,
               mode() within group (order by order_hour) as peak_hour
        from fct_orders join dim_stores s using (store_key) join dim_date using (date_key)
        group by date_day, store_id, s.city, zone, city_tier""",
    "check_days": """
        select date, count(*) as rows, count(*) - count(order_id) as nulls,
               count(*) filter (total_amount <= 0) as bad,
               count(*) - count(distinct order_id) as repeated
        from typed_orders group by date""",
    "check_lines": """
        select i.date, count(*) as rows, count(*) filter (known.order_id is null) as orphans
        from raw_order_items i
        left join (select distinct order_id from typed_orders) known
          on known.order_id = i.order_id
        group by i.date""",
    "product_months": """
        select year, month, product_id, product_name, category, subcategory, mrp, price_band,
               count(distinct order_id) as orders_containing_product,
               sum(qty) as total_units_sold, sum(line_total) as total_revenue,
               round(avg(unit_price), 2) as avg_selling_price,
               round(avg(qty), 2) as avg_qty_per_order,
               round(sum(line_total) / sum(qty), 2) as revenue_per_unit
        from fct_order_items join dim_products using (product_key) join dim_date using (date_key)
        where status = 'delivered'
        group by all""",
    "mart_product_rankings": """
        select *,
               dense_rank() over (partition by year, month, category order by total_revenue desc)
                   as rank_in_category,
               dense_rank() over (partition by year, month order by total_revenue desc)
                   as overall_rank
        from product_months""",
}


def _blocks_for(sql: str) -> list[str]:
    """Names of the blocks that ``sql`` uses, directly or not, in defining order."""
    needed: set[str] = set()
    texts = [sql]
    while texts:
        words = set(re.findall(r"\w+", texts.pop()))
        for name in words & BLOCKS.keys() - needed:
            needed.add(name)
            texts.append(BLOCKS[name])
    return [name for name in BLOCKS if name in needed]


def _query(sql: str) -> str:
    blocks = ",\n".join(f"{name} as ({BLOCKS[name]})" for name in _blocks_for(sql))
    return f"with {blocks}\n{sql}"


def _surface(table: str, counts: str = "", money: str = "") -> str:
    """All columns of a block, the named ones cast to bigint and double."""
    casts = [f"{c}::bigint as {c}" for c in counts.split()]
    casts += [f"{c}::double as {c}" for c in money.split()]
    replaced = f" replace ({', '.join(casts)})" if casts else ""
    return _query(f"select *{replaced} from {table}")


def _failures(rules: list[tuple[str, str, str, str]]) -> str:
    """Union of (table, column, test, failing) for (table, column, test, count SQL)."""
    return _query(
        "\nunion all\n".join(
            f"select '{t}' as table_name, '{c}' as column_name, '{k}' as test, "
            f"({sql})::bigint as failing"
            for t, c, k, sql in rules
        )
    )


# Declared columns per table; the raw orders are the typed but uncleaned ones and the
# raw lines still hold their copies, so that there is something to find.
NOT_NULL = {
    "raw_orders": "order_id customer_id store_id",
    "raw_order_items": "order_item_id order_id product_id",
    "raw_products": "product_id",
    "raw_customers": "customer_id",
    "raw_stores": "store_id",
    "dim_date": "date_key date_day",
    "dim_customers": "customer_key customer_id",
    "dim_products": "product_key",
    "dim_stores": "store_key",
    "fct_orders": "order_id total_amount",
    "fct_order_items": "order_item_id",
}
UNIQUE = {
    "raw_orders": "order_id",
    "raw_order_items": "order_item_id",
    "raw_products": "product_id",
    "raw_customers": "customer_id",
    "raw_stores": "store_id",
    "dim_date": "date_key date_day",
    "dim_customers": "customer_key customer_id",
    "dim_products": "product_key",
    "dim_stores": "store_key",
    "fct_orders": "order_id",
    "fct_order_items": "order_item_id",
}
CHECKED_TABLE = {"raw_orders": "typed_orders", "raw_order_items": "order_lines"}


def _not_null_rules():
    return [
        (t, c, "not_null", f"select count(*) from {CHECKED_TABLE.get(t, t)} where {c} is null")
        for t, columns in NOT_NULL.items()
        for c in columns.split()
    ]


def _unique_rules():
    return [
        (
            t,
            c,
            "unique",
            f"select count(*) from (select {c} from {CHECKED_TABLE.get(t, t)} "
            f"where {c} is not null group by {c} having count(*) > 1)",
        )
        for t, columns in UNIQUE.items()
        for c in columns.split()
    ]


STATUS_CHECK = "status not in ('delivered', 'cancelled', 'returned')"


def oracle_sql() -> dict[str, str]:
    order_counts = "order_hour order_dow is_delivered is_cancelled is_returned is_express delivery_minutes"
    return {
        "clean_order_items_dedup": _surface("raw_order_items", "qty"),
        "clean_orders_coerce": _query("""
            select order_id, customer_id, store_id, city, created_at, status, total_amount,
                   delivery_minutes::bigint as delivery_minutes, is_late, date
            from typed_orders
            where order_id is not null and customer_id is not null
              and store_id is not null and created_at is not null
            qualify row_number() over (partition by order_id order by key, copy) = 1"""),
        "clean_order_items_coerce": _query("""
            select order_item_id, order_id, product_id,
                   try_cast(try_cast(qty as integer) as bigint) as qty, unit_price, line_total, date
            from typed_lines
            where order_item_id is not null and product_id is not null
              and (qty is null or qty = trunc(qty))
            qualify row_number() over (partition by order_item_id order by copy) = 1"""),
        "rejected_order_items": _query("""
            select order_item_id, order_id, product_text as product_id, qty_text as qty,
                   date::varchar as date, line_total
            from typed_lines where qty <> trunc(qty)"""),
        "stg_orders": _surface("stg_orders", "order_hour order_dow delivery_minutes", "total_amount"),
        "stg_order_items": _surface("stg_order_items", "qty", "unit_price line_total"),
        "stg_products": _surface("stg_products", money="mrp"),
        "stg_customers": _surface("stg_customers", "city_tier customer_age_days"),
        "stg_stores": _surface("stg_stores"),
        "dim_customers": _surface("dim_customers", "city_tier customer_age_days"),
        "dim_products": _surface("dim_products", money="mrp"),
        "dim_stores": _surface("dim_stores", "city_tier"),
        "fct_orders": _surface("fct_orders", "date_key " + order_counts, "total_amount"),
        "fct_order_items": _surface("fct_order_items", "date_key qty", "unit_price line_total"),
        "mart_daily_sales": _surface(
            "mart_daily_sales",
            "year month week_of_year total_orders delivered_orders cancelled_orders "
            "returned_orders unique_customers",
            "total_gmv net_revenue",
        ),
        "mart_store_performance": _surface(
            "mart_store_performance",
            "city_tier total_orders delivered_orders cancelled_orders unique_customers peak_hour",
            "total_gmv",
        ),
        "mart_product_rankings": _surface(
            "mart_product_rankings",
            "year month orders_containing_product total_units_sold rank_in_category overall_rank",
            "mrp total_revenue",
        ),
        "profile_orders": _query("""
            select count(*) as total_orders, min(created_at) as earliest, max(created_at) as latest,
                   count(distinct store_id) as distinct_stores,
                   count(distinct customer_id) as distinct_customers,
                   round(avg(total_amount::decimal(12, 2)), 2) as avg_order_value,
                   sum(total_amount::decimal(12, 2))::double as total_gmv
            from raw_orders"""),
        "profile_status": _query("""
            select status, count(*) as cnt,
                   round(100.0 * count(*) / (select count(*) from raw_orders), 1) as pct
            from raw_orders group by status"""),
        "profile_nulls": _query("""
            select count(*) as total_rows, count(*) - count(order_id) as null_order_id,
                   count(*) - count(product_id) as null_product_id, count(*) - count(qty) as null_qty
            from order_lines"""),
        "profile_category_gmv": _query("""
            select category, count(*) as line_items,
                   round(sum(line_total::decimal(12, 2))::double, 0) as gmv
            from raw_order_items join raw_products using (product_id) group by category"""),
        "dq_not_null": _failures(_not_null_rules()),
        "dq_unique": _failures(_unique_rules()),
        "dq_accepted_values": _failures([
            ("raw_orders", "status", "accepted_values",
             f"select count(*) from typed_orders where {STATUS_CHECK}"),
            ("fct_orders", "status", "accepted_values",
             f"select count(*) from fct_orders where {STATUS_CHECK}"),
        ]),
        "dq_expression": _failures([
            ("raw_orders", "total_amount", "expression",
             "select count(*) from typed_orders where total_amount < 0"),
            ("fct_orders", "total_amount", "expression",
             "select count(*) from fct_orders where total_amount < 0"),
            ("fct_order_items", "qty", "expression",
             "select count(*) from fct_order_items where qty <= 0"),
        ]),
        "dq_orders_daily": _query("""
            select date, count(*) as order_rows,
                   count(*) - count(order_id) as null_order_ids,
                   count(*) filter (total_amount <= 0) as non_positive_totals,
                   count(*) - count(distinct order_id) as repeated_order_ids,
                   count(*) >= 100 as enough_rows
            from typed_orders group by date"""),
        "dq_items_orphans": _query("""
            select date, count(*) as item_rows,
                   count(*) filter (not exists (
                       select 1 from raw_orders o
                       where o.order_id = if(ends_with(i.order_id, '77'), 'gone' || i.order_id, i.order_id)
                   )) as orphaned_items
            from raw_order_items i group by date"""),
        "dq_daily_checks": _query("""
            select date as run_date, 'raw_orders' as table_name, rows as rows_loaded,
                   'raw_orders: ' || unnest(['no nulls on order_id', 'positive total_amount',
                                             'no duplicate order_ids', 'min daily rows']) as check_name,
                   unnest([if(nulls = 0, 'PASS', 'FAIL'), if(bad = 0, 'PASS', 'FAIL'),
                           if(repeated = 0, 'PASS', 'FAIL'), if(rows >= 100, 'PASS', 'FAIL')]) as status,
                   unnest([nulls, bad, repeated, rows])::varchar as message
            from check_days
            union all
            select d.date, 'raw_order_items', coalesce(l.rows, 0),
                   'raw_order_items: referential integrity',
                   if(coalesce(orphans, 0) = 0, 'PASS', 'FAIL'), coalesce(orphans, 0)::varchar
            from check_days d left join check_lines l on l.date = d.date"""),
    }
