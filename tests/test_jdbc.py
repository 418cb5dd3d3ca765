"""Publishing without a database: options, row check and retry."""

from __future__ import annotations

import pytest

from qcmart.sources import jdbc

TARGET = jdbc.ServingDatabase("jdbc:x:y", schema="serving", properties={"user": "u"})


def test_options():
    assert TARGET.table("mart") == "serving.mart"
    assert jdbc.ServingDatabase("jdbc:x:y").table("mart") == "mart"
    assert TARGET.write_options() == {"user": "u", "batchsize": "10000", "numPartitions": "8"}


@pytest.fixture
def writes(monkeypatch, spark):
    from pyspark.sql.readwriter import DataFrameWriter

    done = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table: done.append((url, table)))
    return done


def test_rows_written_twice_are_written_anew(spark, writes, monkeypatch):
    counts = iter([7, 5])
    monkeypatch.setattr(jdbc, "stored_rows", lambda *_: next(counts))
    assert jdbc.publish(spark, spark.range(5), TARGET, "mart") == 5
    assert writes == [("jdbc:x:y", "serving.mart")] * 2


def test_lasting_difference_is_an_error(spark, writes, monkeypatch):
    monkeypatch.setattr(jdbc, "stored_rows", lambda *_: 4)
    with pytest.raises(RuntimeError, match="4 rows stored, 5 expected"):
        jdbc.publish(spark, spark.range(5), TARGET, "mart")


def test_no_schema_needs_no_connection(spark):
    jdbc.ensure_schema(spark, jdbc.ServingDatabase("jdbc:none"))
