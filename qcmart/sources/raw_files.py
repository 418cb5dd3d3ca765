"""Readers of the raw layer: one CSV per table and day, one per reference table.

Daily tables lie at ``base/table/YYYY/MM/DD/table.csv`` and reference tables at
``base/table/table.csv``. A ``table.csv`` may be one file or a directory of parts.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qcmart.functions import blank_to_null
from qcmart.sources import files
from qcmart.sources.schemas import DAILY_TABLES, LOAD_DATE, RAW_TABLES, REFERENCE_TABLES

# Position of a row: file, offset of its block in the file, row within the block.
POSITION = ("__file", "__block", "__row")


def day_path(base: str, table: str, day: dt.date) -> str:
    return f"{base}/{table}/{day:%Y/%m/%d}/{table}.csv"


def days_between(start: dt.date, end: dt.date) -> list[dt.date]:
    return [start + dt.timedelta(days=n) for n in range((end - start).days + 1)]


def days_present(
    spark: SparkSession, base: str, table: str, days: Sequence[dt.date]
) -> list[dt.date]:
    """Those of ``days`` that have a file. One day is looked up, many are listed."""
    if len(days) <= 1:
        return [d for d in days if files.exists(spark, day_path(base, table, d))]
    paths = files.glob(spark, f"{base}/{table}/*/*/*/{table}.csv")
    dated = re.compile(rf"/{table}/(\d{{4}})/(\d{{2}})/(\d{{2}})/{table}\.csv$")
    found = {dt.date(*map(int, m.groups())) for m in map(dated.search, paths) if m}
    return sorted(found.intersection(days))


def _options(spark: SparkSession, multiline: bool):
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
    )


def _read_text(
    spark: SparkSession, paths: Sequence[str], table: str, multiline: bool
) -> DataFrame:
    """All columns of the table as text, taken by the names in the file header.

    Files read together must agree on their header, or the read fails. A file split
    into blocks keeps its row order in the ``POSITION`` columns.
    """
    header = _options(spark, multiline).csv(paths[0]).columns
    missing = [c for c in RAW_TABLES[table].names if c not in header]
    if missing:
        raise ValueError(f"{paths[0]}: no column {', '.join(missing)}")
    as_text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    rows = (
        _options(spark, multiline).schema(as_text).option("enforceSchema", False).csv(list(paths))
    )
    return rows.select(
        *RAW_TABLES[table].names,
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__row"),
    )


def _no_rows(spark: SparkSession, table: str) -> DataFrame:
    text = [T.StructField(c, T.StringType()) for c in RAW_TABLES[table].names]
    position = [
        T.StructField("__file", T.StringType()),
        T.StructField("__block", T.LongType()),
        T.StructField("__row", T.LongType()),
    ]
    return spark.createDataFrame([], T.StructType(text + position))


def _with_load_date(rows: DataFrame, table: str) -> DataFrame:
    day = F.regexp_extract("__file", rf"/{table}/(\d{{4}}/\d{{2}}/\d{{2}})/", 1)
    return rows.withColumn(LOAD_DATE, F.to_date(day, "yyyy/MM/dd"))


def read_raw_days(
    spark: SparkSession,
    base: str,
    table: str,
    days: Sequence[dt.date],
    multiline: bool = False,
) -> DataFrame:
    """Text rows of a daily table for ``days`` in one scan; days without a file give none.

    Only a missing file is tolerated, every other failure surfaces. ``multiline``
    allows line breaks inside quotes, at the price of unsplittable files.
    """
    if table not in DAILY_TABLES:
        raise ValueError(f"not a daily table: {table}")
    present = days_present(spark, base, table, days)
    if not present:
        return _with_load_date(_no_rows(spark, table), table)
    paths = [day_path(base, table, d) for d in present]
    return _with_load_date(_read_text(spark, paths, table, multiline), table)


def read_raw_day(
    spark: SparkSession, base: str, table: str, day: dt.date, multiline: bool = False
) -> DataFrame:
    """Text rows of a daily table for one day; no rows when the file is missing."""
    return read_raw_days(spark, base, table, [day], multiline)


def read_raw_all(
    spark: SparkSession, base: str, table: str, multiline: bool = False
) -> DataFrame:
    """Text rows of every day of a daily table in one scan."""
    paths = files.glob(spark, f"{base}/{table}/*/*/*/{table}.csv")
    rows = _read_text(spark, paths, table, multiline) if paths else _no_rows(spark, table)
    return _with_load_date(rows, table)


def reference_path(base: str, table: str) -> str:
    return f"{base}/{table}/{table}.csv"


def reference_present(spark: SparkSession, base: str, table: str) -> bool:
    return files.exists(spark, reference_path(base, table))


def read_reference(
    spark: SparkSession, base: str, table: str, multiline: bool = False
) -> DataFrame:
    """A reference table in its declared types; no rows when the file is missing.

    Nothing is cleaned: a value that does not fit its type fails the read.
    """
    schema = REFERENCE_TABLES[table]
    if not reference_present(spark, base, table):
        return spark.createDataFrame([], schema)
    text = _read_text(spark, [reference_path(base, table)], table, multiline)

    def typed(field: T.StructField):
        value = blank_to_null(field.name)
        if isinstance(field.dataType, T.IntegerType):
            value = F.rint(value.cast("double"))
        return value.cast(field.dataType).alias(field.name)

    return text.select(*[typed(f) for f in schema.fields])
