"""Publishing of models to a serving database."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = 10_000


@dataclass(frozen=True)
class ServingDatabase:
    """A JDBC target. ``connections`` bounds how many tasks write at once."""

    url: str
    schema: str = ""
    properties: Mapping[str, str] = field(default_factory=dict)
    connections: int = 8
    batch_rows: int = BATCH_ROWS

    def table(self, name: str) -> str:
        return f"{self.schema}.{name}" if self.schema else name

    def write_options(self) -> dict[str, str]:
        return {
            **self.properties,
            "batchsize": str(self.batch_rows),
            "numPartitions": str(self.connections),
        }


def ensure_schema(spark: SparkSession, target: ServingDatabase) -> None:
    """Create the target schema if the database does not have it."""
    if not target.schema:
        return
    jvm = spark._jvm
    settings = jvm.java.util.Properties()
    for key, value in target.properties.items():
        settings.setProperty(key, value)
    if "driver" in target.properties:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(
            target.properties["driver"]
        )
    connection = jvm.java.sql.DriverManager.getConnection(target.url, settings)
    try:
        schemas = connection.getMetaData().getSchemas()
        present = set()
        while schemas.next():
            present.add(schemas.getString(1).lower())
        if target.schema.lower() not in present:
            connection.createStatement().execute(f"create schema {target.schema}")
    finally:
        connection.close()


def stored_rows(spark: SparkSession, target: ServingDatabase, name: str) -> int:
    """Rows the database holds; the count runs in the database."""
    query = f"select count(*) as n from {target.table(name)}"
    reader = spark.read.format("jdbc").option("url", target.url).option("query", query)
    return int(reader.options(**target.properties).load().first()[0])


def publish(
    spark: SparkSession, df: DataFrame, target: ServingDatabase, name: str, attempts: int = 2
) -> int:
    """Replace a serving table with ``df``; row count.

    A task that is lost after its commit is run again and would leave its rows
    twice, so the stored rows are compared with the rows of ``df`` and the table is
    written anew when they differ.
    """
    expected = df.count()
    for _ in range(attempts):
        df.write.mode("overwrite").options(**target.write_options()).jdbc(
            target.url, target.table(name)
        )
        found = stored_rows(spark, target, name)
        if found == expected:
            return found
    raise RuntimeError(f"{target.table(name)}: {found} rows stored, {expected} expected")
