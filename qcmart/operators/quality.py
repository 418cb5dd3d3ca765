"""Quality checks: failing rows, failure counts and the daily checks."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    """One declared expectation on a column.

    ``kind`` is ``not_null``, ``unique``, ``accepted_values`` or ``expression``.
    """

    table: str
    column: str
    kind: str
    values: tuple[str, ...] = ()
    expression: str = ""
    name: str = field(default="", compare=False)

    def __post_init__(self):
        if not self.name:
            object.__setattr__(self, "name", f"{self.kind}_{self.table}_{self.column}")


def violation(rule: Rule) -> str:
    """SQL condition of a failing row, for the rules that look at single rows."""
    if rule.kind == "not_null":
        return f"{rule.column} is null"
    if rule.kind == "accepted_values":
        quoted = (str(v).replace("\\", "\\\\").replace("'", "\\'") for v in rule.values)
        accepted = ", ".join(f"'{v}'" for v in quoted)
        return f"{rule.column} not in ({accepted})"
    if rule.kind == "expression":
        return f"not ({rule.column} {rule.expression})"
    raise ValueError(f"unknown rule kind: {rule.kind}")


def failing_rows(df: DataFrame, rule: Rule) -> DataFrame:
    """Rows that break the rule; for ``unique``, the repeated values with their counts.

    Except for ``not_null``, a NULL passes.
    """
    if rule.kind == "unique":
        present = df.where(f"{rule.column} is not null")
        counts = present.groupBy(rule.column).agg(F.expr("count(*) as n_records"))
        return counts.where("n_records > 1")
    return df.where(violation(rule))


def failure_counts(tables: Mapping[str, DataFrame], rules: Iterable[Rule]) -> DataFrame:
    """One row per rule with the number of failures.

    All single-row rules of a table share one scan. All ``unique`` rules share one grouping, by
    rule and value, of one scan per table; values are combined before its shuffle.
    """
    together: dict[str, list[str]] = defaultdict(list)
    unique: dict[str, list[tuple[int, Rule]]] = defaultdict(list)
    labels: list[str] = []
    for rule in rules:
        label = (
            f"'{rule.table}' as table_name, '{rule.column}' as column_name, "
            f"'{rule.kind}' as test"
        )
        if rule.kind == "unique":
            unique[rule.table].append((len(labels), rule))
            labels.append(label)
        else:
            failing = f"count_if({violation(rule)}) as failing"
            together[rule.table].append(f"struct({label}, {failing})")
    parts: list[DataFrame] = []
    if unique:
        values = [_values(tables[name], some) for name, some in unique.items()]
        counts = reduce(DataFrame.unionAll, values).groupBy("rule", "value").agg(F.count("*").alias("n"))
        failing = [f"struct({label}, count_if(n > 1 and rule = {k}) as failing)" for k, label in enumerate(labels)]
        parts.append(counts.selectExpr(f"inline(array({', '.join(failing)}))"))
    for name, rows in together.items():
        parts.append(tables[name].selectExpr(f"inline(array({', '.join(rows)}))"))
    return reduce(DataFrame.unionAll, parts)


def _values(df: DataFrame, rules: Sequence[tuple[int, Rule]]) -> DataFrame:
    """(rule, value) of every present value that a ``unique`` rule looks at; equal values are equal texts."""

    def text(column: str) -> Column:
        # zero has two signs, and equals itself whatever the sign
        floating = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))
        return (F.col(column) + F.lit(0.0) if floating else F.col(column)).cast("string")

    each = [F.struct(F.lit(k).alias("rule"), text(r.column).alias("value")) for k, r in rules]
    return df.select(F.inline(F.array(*each))).where("value is not null")


def daily_order_counts(raw_orders: DataFrame, min_rows: int = 100) -> DataFrame:
    """Per day of orders, in one pass: rows, NULL ids, non-positive totals, repeated
    ids (a NULL id counts as repeated) and whether there are enough rows."""
    return raw_orders.groupBy("date").agg(
        F.count(F.lit(1)).alias("order_rows"),
        F.count_if(F.col("order_id").isNull()).alias("null_order_ids"),
        F.count_if(F.col("total_amount") <= 0).alias("non_positive_totals"),
        (F.count(F.lit(1)) - F.count_distinct("order_id")).alias("repeated_order_ids"),
        (F.count(F.lit(1)) >= min_rows).alias("enough_rows"),
    )


def daily_orphans(
    raw_order_items: DataFrame,
    raw_orders: DataFrame,
    likely_orders: DataFrame | None = None,
) -> DataFrame:
    """Per day of order lines: rows, and lines whose order exists in no ``raw_orders``.

    Lines are counted per order first, so an order with very many lines enters the
    join as a single row. ``likely_orders``, a small part of the orders that should
    match nearly all lines, leaves only the rest to be sought among all orders.
    """
    items = raw_order_items.where("date is not null")
    lines = items.groupBy("date", "order_id").agg(F.count(F.lit(1)).alias("lines"))
    first = raw_orders if likely_orders is None else likely_orders
    lines = lines.join(_ids(first, "__known"), "order_id", "left")
    orphaned = F.col("__known").isNull()
    if likely_orders is not None:
        rest = lines.where(orphaned).select("order_id")
        others = raw_orders.join(rest, "order_id", "left_semi")
        lines = lines.join(_ids(others, "__found"), "order_id", "left")
        orphaned &= F.col("__found").isNull()
    return lines.groupBy("date").agg(
        F.sum("lines").alias("item_rows"),
        F.sum(F.when(orphaned, F.col("lines")).otherwise(0)).alias("orphaned_items"),
    )


def _ids(orders: DataFrame, mark: str) -> DataFrame:
    return orders.select("order_id").distinct().withColumn(mark, F.lit(True))


# Name, checked table, measured value and passing condition of each daily check.
DAILY_CHECKS: Sequence[tuple[str, str, str, str, str]] = (
    ("no nulls on order_id", "raw_orders", "order_rows", "null_order_ids", "= 0"),
    ("positive total_amount", "raw_orders", "order_rows", "non_positive_totals", "= 0"),
    ("no duplicate order_ids", "raw_orders", "order_rows", "repeated_order_ids", "= 0"),
    ("referential integrity", "raw_order_items", "item_rows", "orphaned_items", "= 0"),
    ("min daily rows", "raw_orders", "order_rows", "order_rows", ">= {min_rows}"),
)


def daily_check_results(
    raw_orders: DataFrame,
    raw_order_items: DataFrame,
    all_orders: DataFrame | None = None,
    min_rows: int = 100,
) -> DataFrame:
    """One row per day with orders and per check, shaped like the audit trail.

    ``raw_orders`` and ``raw_order_items`` hold the days to check; ``all_orders`` the
    orders of every day, where those are more. Days without orders are not checked.
    """
    days = daily_order_counts(raw_orders, min_rows).where("date is not null")
    if all_orders is None:
        orphans = daily_orphans(raw_order_items, raw_orders)
    else:
        orphans = daily_orphans(raw_order_items, all_orders, likely_orders=raw_orders)
    days = days.join(orphans, "date", "left").na.fill(0, ["item_rows", "orphaned_items"])
    checks = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.col(rows).cast("bigint").alias("rows_loaded"),
            F.lit(f"{table}: {name}").alias("check_name"),
            F.when(F.expr(f"{value} {test.format(min_rows=min_rows)}"), "PASS")
            .otherwise("FAIL")
            .alias("status"),
            F.col(value).cast("string").alias("message"),
        )
        for name, table, rows, value, test in DAILY_CHECKS
    ]
    return days.select(
        F.col("date").alias("run_date"), F.explode(F.array(*checks)).alias("c")
    ).select("run_date", "c.*")
