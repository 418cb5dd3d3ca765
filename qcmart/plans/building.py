"""Writing the models: all of them, or what a change of some days reaches."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qcmart.operators import facts, marts, quality, staging
from qcmart.plans import models as m
from qcmart.plans.job import Job, QualityError, RunReport, raw_tables
from qcmart.plans.rules import DIMENSION_KEY_RULES
from qcmart.sources import tables
from qcmart.sources.schemas import DAILY_TABLES
from qcmart.sources.tables import MARTS

def _models(job: Job, raw: Mapping[str, DataFrame]) -> m.Models:
    return m.Models(
        job.spark,
        raw,
        as_of=job.as_of,
        tier_1=job.tier_1,
        calendar_start=job.calendar_start,
        calendar_end=job.calendar_end,
        holidays=job.holidays,
        sketches={f"raw_{t}": tables.read_sketches(job.warehouse, t) for t in DAILY_TABLES},
    )


def require_unique_dimension_keys(raw: Mapping[str, DataFrame]) -> None:
    """Stop before facts are built if a repeated dimension key would multiply them."""
    counts = quality.failure_counts(raw, DIMENSION_KEY_RULES).where("failing > 0")
    repeated = [f"{r.table_name}.{r.column_name}" for r in counts.collect()]
    if repeated:
        raise QualityError(f"repeated keys in {', '.join(sorted(repeated))}")


def build_models(job: Job) -> m.Models:
    """Write dimensions, facts and marts in dependency order; staging stays a view.

    Each model reads the written tables of those before it, so nothing is computed
    twice and a lost executor costs at most the work of one model.
    """
    raw = raw_tables(job)
    require_unique_dimension_keys(raw)
    built = _models(job, raw)
    for name in m.STAGING:
        tables.publish_view(built[name], name)
    for name in m.BUILD_ORDER:
        _store(job, built, name)
    return built


def stored_models(job: Job) -> m.Models:
    """The models as they were written last."""
    built = _models(job, raw_tables(job))
    for name in m.BUILD_ORDER:
        built.use(name, tables.read_model(job.warehouse, MARTS, name, built[name].schema))
    return built


def _store(job: Job, built: m.Models, name: str) -> None:
    part, by = m.part_of(name, job.calendar_start, job.calendar_end), m.PARTITIONS.get(name, ())
    built.use(name, tables.materialize(job.warehouse, MARTS, name, built[name], part, by))


# Dimensions that decide rows of other days: their key, the columns that matter, and
# the daily table that refers to them.
_REFERRED = (
    ("dim_customers", "customer_id", ["customer_id"], "orders"),
    ("dim_stores", "store_id", None, "orders"),
    ("dim_products", "product_id", None, "order_items"),
)


def _other_days_change(job: Job, built: m.Models, loaded: Mapping[str, Collection[str]]) -> bool:
    """True if the new dimensions alter rows of other loads than ``loaded``: if something
    was removed or altered, or an added key is referred to by another load."""
    for name, key, columns, referring in _REFERRED:
        new = built[name].select(*(columns or built[name].columns))
        old = tables.read_model(job.warehouse, MARTS, name, new.schema)
        if not old.exceptAll(new).isEmpty():
            return True
        added = new.select(F.col(key).alias("id")).join(old.select(F.col(key).alias("id")), "id", "left_anti")
        if added.isEmpty():
            continue
        if not tables.holders(job.warehouse, referring, key, added, but=loaded[f"raw_{referring}"]).isEmpty():
            return True
    calendar = built["dim_date"]
    old = tables.read_model(job.warehouse, MARTS, "dim_date", calendar.schema)
    return not (old.exceptAll(calendar).isEmpty() and calendar.exceptAll(old).isEmpty())


def _part(job: Job, day: Column) -> Column:
    return m.day_part(day, job.calendar_start, job.calendar_end)


def _on(job: Job, day: Column, days: Collection[str]) -> Column:
    """True for rows of the given parts of the calendar, false for all others."""
    dates = [dt.date.fromisoformat(d) for d in days if d != m.OTHER_DAYS]
    known = F.coalesce(day.isin(*dates), F.lit(False))
    if m.OTHER_DAYS not in days:
        return known
    return known | F.coalesce(~day.between(F.lit(job.calendar_start), F.lit(job.calendar_end)), F.lit(True))


def _months(items: DataFrame) -> set[tuple[int, int]]:
    keys = items.where("date_key is not null").selectExpr("date_key div 100 as m").distinct()
    return {divmod(r.m, 100) for r in keys.collect()}


def refresh_models(job: Job, report: RunReport) -> m.Models:
    """Bring the stored models up to date after the loads of ``report``.

    Rewrites the facts and daily marts of the days whose rows came or went and the rankings of
    the months they reach, and equals a full build. Of other loads it reads what the index of
    keys names. Where the days don't tell, after a first load or a change of dimensions
    that reaches other loads, all is built anew.
    """
    raw = raw_tables(job)
    built = _models(job, raw)
    wh = job.warehouse
    if not all(wh.exists(MARTS, name) for name in m.BUILD_ORDER):
        return build_models(job)
    if _other_days_change(job, built, report.loads):
        return build_models(job)
    days = {
        f"raw_{t}": tables.days_in(wh, t, report.touched[f"raw_{t}"], _part(job, F.col("date")))
        for t in DAILY_TABLES
    }
    require_unique_dimension_keys(raw)
    for name in m.STAGING:
        tables.publish_view(built[name], name)
    for name in m.DIMENSIONS:
        _store(job, built, name)

    def replace(name: str, df: DataFrame, parts: Collection[str]) -> None:
        part = m.part_of(name, job.calendar_start, job.calendar_end)
        built.use(name, tables.replace_parts(wh, MARTS, name, df, part, parts, m.PARTITIONS[name]))

    def stored(name: str, schema, parts: Collection[str]) -> DataFrame:
        return tables.read_model(wh, MARTS, name, schema, parts)

    day = F.col("order_date")
    order_days, item_days = set(days["raw_orders"]), set(days["raw_order_items"])
    orders = _rows_of(job, "orders", order_days)
    fresh = facts.fct_orders(
        staging.stg_orders(orders),
        built.dim_customers,
        built.dim_stores,
        built.dim_date,
        built.sketches["raw_orders"],
    )
    changed = stored("fct_orders", fresh.schema, order_days).select(F.col("order_id").alias("id"))
    changed = changed.unionAll(orders.select(F.col("order_id").alias("id")))
    # Lines of other days that belong to a changed order change with it.
    own = report.loads["raw_order_items"]
    affected = tables.load_days_of(tables.holders(wh, "order_items", "order_id", changed, but=own))
    affected = staging.stg_order_items(tables.read_raw(wh, "order_items", affected))
    affected = affected.join(changed, affected.order_id == F.col("id"), "left_semi")
    item_days.update(r.part for r in affected.select(_part(job, day).alias("part")).distinct().collect())
    items_schema = built.fct_order_items.schema
    months = _months(stored("fct_order_items", items_schema, item_days))

    replace("fct_orders", fresh, order_days)
    lines = staging.stg_order_items(_rows_of(job, "order_items", item_days))
    same_days = stored("fct_orders", fresh.schema, order_days | item_days)
    unmatched = lines.select("order_id").join(same_days, "order_id", "left_anti")
    elsewhere = tables.holders(wh, "orders", "order_id", unmatched.select(F.col("order_id").alias("id")))
    elsewhere = tables.read_raw(wh, "orders", tables.load_days_of(elsewhere))
    other_days = elsewhere.join(unmatched, "order_id", "left_semi").select(_part(job, F.col("date")).alias("part"))
    other_days = {r.part for r in other_days.distinct().collect()} - order_days - item_days
    elsewhere = stored("fct_orders", fresh.schema, other_days)
    headers = same_days.unionAll(elsewhere.join(unmatched, "order_id", "left_semi"))
    replace(
        "fct_order_items",
        facts.fct_order_items(lines, headers, built.dim_products, built.sketches["raw_order_items"]),
        item_days,
    )
    months |= _months(stored("fct_order_items", items_schema, item_days))

    orders = stored("fct_orders", fresh.schema, order_days)
    state = {"order_counters": marts.order_counters(orders), "order_buyers": marts.order_buyers(orders)}
    for name, df in state.items():
        replace(name, df, order_days)
        state[name] = stored(name, df.schema, order_days)
    replace("mart_daily_sales", marts.daily_sales(*state.values(), built.dim_date), order_days)
    replace(
        "mart_store_performance",
        marts.store_performance(*state.values(), built.dim_stores, built.dim_date),
        order_days,
    )
    in_months = [d for d in _calendar(job) if (d.year, d.month) in months]
    items = stored("fct_order_items", items_schema, {d.isoformat() for d in in_months})
    replace(
        "mart_product_rankings",
        marts.mart_product_rankings(items, built.dim_products, built.dim_date),
        {f"{y}-{n}" for y, n in months},
    )
    return built


def _calendar(job: Job) -> list[dt.date]:
    days = (job.calendar_end - job.calendar_start).days + 1
    return [job.calendar_start + dt.timedelta(n) for n in range(days)]


def _rows_of(job: Job, table: str, days: Collection[str]) -> DataFrame:
    """The raw rows of some days, from the loads that hold any."""
    loads = tables.loads_with(job.warehouse, table, lambda day: _on(job, day, days))
    return tables.read_raw(job.warehouse, table, loads).where(_on(job, F.col("date"), days))
