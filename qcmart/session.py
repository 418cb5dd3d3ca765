"""Session settings for local runs, tests and the bench.

On a cluster the caller's session is used as it is: nothing in the library
changes a setting of a session it was handed.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(
    cpus: int | str = "*", app: str = "qcmart", memory: str = "8g", **conf: str
) -> SparkSession:
    """A single-JVM session with one shuffle partition per core and a fixed zone."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else str(cpus))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
