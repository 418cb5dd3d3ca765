"""Small helpers on the file system behind a path, whichever it is."""

from __future__ import annotations

import datetime as dt
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Missing(FileNotFoundError):
    """A file that was listed, or looked for, is not there."""


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _resolve(spark, path)
    return fs.exists(hadoop_path)


def _found(spark: SparkSession, pattern: str) -> list:
    fs, hadoop_path = _resolve(spark, pattern)
    return list(fs.globStatus(hadoop_path) or [])


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching ``pattern``, sorted; empty when there are none."""
    return sorted(s.getPath().toString() for s in _found(spark, pattern))


def older_than(spark: SparkSession, pattern: str, moment: dt.datetime) -> list[str]:
    """Paths matching ``pattern`` that were last modified before ``moment``."""
    limit = moment.timestamp() * 1000
    return sorted(s.getPath().toString() for s in _found(spark, pattern) if s.getModificationTime() < limit)


def fingerprint(spark: SparkSession, path: str) -> str:
    """What changes when a file, or a directory of files, is written again: names, sizes and times."""
    fs, hadoop_path = _resolve(spark, path)
    status = [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(hadoop_path)]
    return str(sorted(status))


def remove_tree(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _resolve(spark, path)
    fs.delete(hadoop_path, True)


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    fs, hadoop_path = _resolve(spark, path)
    fs.create(hadoop_path, True).close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _resolve(spark, path)
    try:
        stream = fs.open(hadoop_path)
    except Py4JJavaError as error:
        if "FileNotFoundException" in str(error.java_exception):
            raise Missing(path) from error
        raise
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that appears as a whole, under a name that is not taken."""
    fs, hadoop_path = _resolve(spark, path)
    _, new = _resolve(spark, f"{path}.{uuid.uuid4().hex}.new")
    stream = fs.create(new, True)
    stream.write(text.encode())
    stream.close()
    if not fs.rename(new, hadoop_path):
        raise OSError(f"{path} could not be named")
