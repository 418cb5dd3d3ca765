"""The stored layers: raw tables, models, audit trail and kept failures.

Everything is Parquet below one warehouse path, replaced by commits (see ``commits``) and
registered in the session catalog as external tables, so data outlives any catalog. The
cleaned daily tables are the warehouse tables; there is no second copy to load.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from collections.abc import Callable, Collection, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qcmart.operators.facts import LINE_REFERENCES, ORDER_REFERENCES
from qcmart.operators import key_index
from qcmart.operators.sketches import SKETCHES, key_sketches
from qcmart.sources import commits, files
from qcmart.sources.commits import PART
from qcmart.sources.schemas import AUDIT_LOG, DAILY_TABLES, LOAD_DATE, REFERENCE_TABLES

RAW, STAGING, MARTS, QUALITY = "raw", "staging", "marts", "quality"
AUDIT_TABLE = "audit_log"

# Keys of the daily tables whose frequent values are sketched with every load.
REFERENCES = {"orders": ORDER_REFERENCES, "order_items": LINE_REFERENCES}

# Keys of the daily tables by which other loads look for their rows.
INDEXED = {
    "orders": ("order_id", "customer_id", "store_id", "date"),
    "order_items": ("order_id", "product_id", "date"),
}

# Parts that one statement adds to the catalog.
PARTS_AT_ONCE = 500


@dataclass(frozen=True)
class Warehouse:
    """Where the layers live: a shared path, and a prefix for database names."""

    spark: SparkSession
    path: str
    prefix: str = ""

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.database(layer)}.{name}"

    def location(self, layer: str, name: str) -> str:
        return f"{self.path}/{layer}/{name}"

    def exists(self, layer: str, name: str) -> bool:
        return commits.exists(self.spark, self.location(layer, name))

    def parts(self, layer: str, name: str) -> dict[str, str]:
        """The data folder of each part of a table."""
        return commits.parts(self.spark, self.location(layer, name))


def _daily_schema(table: str) -> T.StructType:
    """A daily table as stored: its columns and the day of the file that a row came from."""
    return T.StructType([*DAILY_TABLES[table].fields, T.StructField(LOAD_DATE, T.DateType())])


def ensure_tables(wh: Warehouse) -> None:
    """Create the databases and the typed raw and audit tables that are not there yet.

    Tables found on disk but not in the catalog are registered with all their parts.
    """
    spark = wh.spark
    for layer in (RAW, STAGING, MARTS, QUALITY):
        spark.sql(f"create database if not exists {wh.database(layer)}")
    wanted = [(RAW, f"raw_{t}", _daily_schema(t), True) for t in DAILY_TABLES]
    wanted += [(RAW, f"raw_{t}", s, False) for t, s in REFERENCE_TABLES.items()]
    wanted.append((QUALITY, AUDIT_TABLE, AUDIT_LOG, True))
    for layer, name, schema, in_parts in wanted:
        if not spark.catalog.tableExists(wh.table(layer, name)):
            _register(wh, layer, name, schema, wh.parts(layer, name), in_parts=in_parts)


def _register(
    wh: Warehouse,
    layer: str,
    name: str,
    schema: T.StructType,
    added: Mapping[str, str],
    dropped: Iterable[str] = (),
    in_parts: bool = True,
) -> None:
    """Make the catalog name the folders of a table. A table in parts shows them in a partition column."""
    spark, table, root = wh.spark, wh.table(layer, name), wh.location(layer, name)
    folder = added.get(commits.WHOLE, f"{root}/data/none")
    columns = [f for f in schema.fields if f.name != PART]
    shown = T.StructType([*columns, T.StructField(PART, T.StringType())] if in_parts else columns)
    if spark.catalog.tableExists(table):
        known = [(f.name, f.dataType) for f in spark.table(table).schema.fields]
        if known != [(f.name, f.dataType) for f in shown.fields]:
            spark.sql(f"drop table {table}")
            added = wh.parts(layer, name)
    if not spark.catalog.tableExists(table):
        typed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shown.fields)
        by, where = (f"partitioned by ({PART})", f"{root}/data") if in_parts else ("", folder)
        spark.sql(f"create table {table} ({typed}) using parquet {by} location '{where}'")
    elif not in_parts:
        spark.sql(f"alter table {table} set location '{folder}'")
    if in_parts:
        changed = sorted({*added, *dropped})
        for k in range(0, len(changed), PARTS_AT_ONCE):
            some = changed[k : k + PARTS_AT_ONCE]
            gone = ", ".join(f"partition ({PART}='{p}')" for p in some)
            spark.sql(f"alter table {table} drop if exists {gone}")
            new = " ".join(f"partition ({PART}='{p}') location '{added[p]}'" for p in some if p in added)
            if new:
                spark.sql(f"alter table {table} add {new}")
    spark.catalog.refreshTable(table)


def _replace(
    wh: Warehouse,
    layer: str,
    name: str,
    rows: DataFrame,
    part: Column | None = None,
    replaced: Collection[str] = (),
    by: Sequence[str] = (),
    whole: bool = False,
) -> dict[str, str]:
    """Write ``rows`` as new parts, which replace all of ``replaced`` (with ``whole``, all there are), in
    one commit; the folders of the new parts. Without ``part`` the rows are one part."""
    location, schema = wh.location(layer, name), rows.schema
    added = commits.write(rows, location, part, by)
    gone = set(replaced) - set(added)
    if whole:
        gone |= set(wh.parts(layer, name)) - set(added)
    commits.commit(wh.spark, location, added, gone, whole)
    folders = {k: f"{location}/data/{v}" for k, v in added.items()}
    _register(wh, layer, name, schema, folders, gone, in_parts=part is not None)
    return folders


def read_raw(wh: Warehouse, table: str, load_dates: Collection[str] | None = None) -> DataFrame:
    """A raw table in its declared column order, daily tables with their load day last and, if asked,
    only what certain load days brought."""
    schema = _daily_schema(table) if table in DAILY_TABLES else REFERENCE_TABLES[table]
    found = wh.parts(RAW, f"raw_{table}")
    folders = [f for k, f in found.items() if load_dates is None or k in load_dates]
    return commits.read(wh.spark, folders, schema)


def replace_days(
    wh: Warehouse, table: str, rows: DataFrame, load_dates: Sequence[dt.date]
) -> tuple[int, list[str]]:
    """Replace everything that was loaded from the files of ``load_dates``, with the sketches and the
    index of its keys.

    A repeated load leaves the same table. Returns the row count and the folders of all
    rows that came or went; those that went can still be read for a while.
    """
    name, days = f"raw_{table}", [d.isoformat() for d in load_dates]
    before = wh.parts(RAW, name)
    written = Observation()
    counted = rows.select(*_daily_schema(table).names).observe(written, F.count(F.lit(1)).alias("rows"))
    added = _replace(wh, RAW, name, counted, F.col(LOAD_DATE).cast("string"), days, ["date"])
    stored = commits.read(wh.spark, added.values(), _daily_schema(table))
    sketches = key_sketches(stored, REFERENCES[table], per=[LOAD_DATE])
    _replace(wh, RAW, f"key_sketches_{table}", sketches, F.col(LOAD_DATE).cast("string"), days)
    texts = stored.withColumn("date", F.coalesce(F.col("date").cast("string"), F.lit("")))
    index = key_index.key_index(texts, INDEXED[table], LOAD_DATE)
    _replace(wh, RAW, f"key_index_{table}", index, F.col(LOAD_DATE).cast("string"), days, ["key", "bucket"])
    gone = [before[d] for d in days if d in before]
    return written.get["rows"], [*gone, *added.values()]


def read_sketches(wh: Warehouse, table: str) -> DataFrame:
    """Sketches of the keys of a daily table, one for each load day and key."""
    return commits.read(wh.spark, wh.parts(RAW, f"key_sketches_{table}").values(), SKETCHES)


def holders(
    wh: Warehouse, table: str, key: str, ids: DataFrame, but: Collection[str] = ()
) -> DataFrame:
    """(id, load_date) of the load days, ``but`` some, whose rows of a daily table have one of ``ids``
    (column id) as ``key``. Reads the index of these days, and keys only where its bitmaps let one through."""
    found = {k: f for k, f in wh.parts(RAW, f"key_index_{table}").items() if k not in but}

    def read(days: Collection[str]) -> DataFrame:
        return commits.read(wh.spark, [found[d] for d in days], key_index.schema(LOAD_DATE))

    return key_index.holders(read(found), lambda days: read([str(d) for d in days]), key, ids, LOAD_DATE)


def loads_with(wh: Warehouse, table: str, wanted: Callable[[Column], Column]) -> set[str]:
    """The load days that brought a daily table a row whose date, NULL included, is wanted."""
    found = wh.parts(RAW, f"key_index_{table}").values()
    index = commits.read(wh.spark, found, key_index.schema(LOAD_DATE)).where("key = 'date'")
    return load_days_of(index.where(F.exists("ids", lambda day: wanted(day.try_cast("date")))))


def load_days_of(holding: DataFrame) -> set[str]:
    """The load days that ``holders`` found."""
    return {str(r[0]) for r in holding.select(LOAD_DATE).distinct().collect()}


def days_in(wh: Warehouse, table: str, folders: Collection[str], part: Column) -> set[str]:
    """The parts that the rows in some folders of a daily table belong to."""
    rows = commits.read(wh.spark, folders, _daily_schema(table))
    return {r.part for r in rows.select(part.alias("part")).distinct().collect()}


def replace_reference(wh: Warehouse, table: str, rows: DataFrame) -> int:
    """Replace a reference table as a whole; row count."""
    written = Observation()
    counted = rows.observe(written, F.count(F.lit(1)).alias("rows"))
    _replace(wh, RAW, f"raw_{table}", counted, whole=True)
    return written.get["rows"]


def append_audit(wh: Warehouse, results: DataFrame) -> int:
    """Add one row per check result, stamped with the time of writing; failed checks.

    Every call adds a part of its own, so calls at the same time keep each other's rows.
    """
    written = Observation()
    stamped = results.withColumn("loaded_at", F.current_timestamp().cast("timestamp_ntz"))
    rows = stamped.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in AUDIT_LOG.fields]
    ).observe(written, F.count_if(F.col("status") == "FAIL").alias("failed"))
    _replace(wh, QUALITY, AUDIT_TABLE, rows, F.lit(uuid.uuid4().hex))
    return written.get["failed"]


def read_audit(wh: Warehouse) -> DataFrame:
    return commits.read(wh.spark, wh.parts(QUALITY, AUDIT_TABLE).values(), AUDIT_LOG)


def keep_rejects(
    wh: Warehouse, table: str, rows: DataFrame | None, load_dates: Sequence[dt.date], kind: str = "rejected"
) -> None:
    """Keep rows about a raw table by load day (``kind``: rejected ones, or dead letters), replacing
    those of an earlier load.

    Without ``rows`` only the earlier ones go.
    """
    name, days = f"{kind}_{table}", [d.isoformat() for d in load_dates]
    if rows is not None:
        _replace(wh, QUALITY, name, rows, F.col(LOAD_DATE).cast("string"), days)
        return
    gone = set(days) & set(wh.parts(QUALITY, name))
    if gone:
        commits.commit(wh.spark, wh.location(QUALITY, name), {}, gone)
        schema = wh.spark.table(wh.table(QUALITY, name)).schema
        _register(wh, QUALITY, name, schema, {}, gone)


def publish_view(df: DataFrame, name: str) -> None:
    """A staging model: a view, computed whenever it is read."""
    df.createOrReplaceTempView(name)


def materialize(
    wh: Warehouse,
    layer: str,
    name: str,
    df: DataFrame,
    part: Column | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Write a model as a table, replacing it, and return the table as written.

    ``part`` names the part of a row. The table changes at once when all is written.
    """
    added = _replace(wh, layer, name, df, part, by=by, whole=True)
    return commits.read(wh.spark, added.values(), df.schema)


def read_model(
    wh: Warehouse,
    layer: str,
    name: str,
    schema: T.StructType | None = None,
    parts: Collection[str] | None = None,
) -> DataFrame:
    """A stored model or some of its parts; with ``schema`` also one that has no part yet."""
    found = wh.parts(layer, name)
    folders = sorted(f for k, f in found.items() if parts is None or k in parts)
    if schema is None:
        return wh.spark.read.option("recursiveFileLookup", True).parquet(*folders)
    return commits.read(wh.spark, folders, schema)


def replace_parts(
    wh: Warehouse,
    layer: str,
    name: str,
    df: DataFrame,
    part: Column,
    replaced: Collection[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Replace the named parts of a model with ``df``, which has rows of no other part; the table as written."""
    _replace(wh, layer, name, df, part, replaced, by)
    return read_model(wh, layer, name, df.schema)


def drop_model(wh: Warehouse, layer: str, name: str) -> None:
    """Forget a table and remove its files."""
    wh.spark.sql(f"drop table if exists {wh.table(layer, name)}")
    files.remove_tree(wh.spark, wh.location(layer, name))


def clean(wh: Warehouse, kept: dt.timedelta = commits.KEPT) -> None:
    """Remove what was replaced, or written and never committed, longer ago than ``kept``."""
    for log in files.glob(wh.spark, f"{wh.path}/*/*/_commits"):
        commits.clean(wh.spark, log.rsplit("/", 1)[0], kept)


def _ledger(wh: Warehouse, table: str) -> str:
    return f"{wh.path}/_ledger/{table}"


def note_loaded(wh: Warehouse, table: str, inputs: Mapping[str, str]) -> None:
    """Note that inputs, given by name with the fingerprint of their files, are loaded."""
    for name, fingerprint in inputs.items():
        path = f"{_ledger(wh, table)}/{name}"
        files.remove_tree(wh.spark, path)
        files.write_text(wh.spark, path, fingerprint)


def loaded_inputs(wh: Warehouse, table: str, names: Iterable[str]) -> dict[str, str]:
    """The fingerprints under which inputs were loaded last."""
    found = {}
    for name in names:
        with contextlib.suppress(files.Missing):
            found[name] = files.read_text(wh.spark, f"{_ledger(wh, table)}/{name}")
    return found
