from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from qcmart import functions as Q


def one(spark, column, **values):
    names = list(values)
    row = tuple(values.values())
    kinds = {str: "string", float: "double", int: "int", Decimal: "decimal(12,2)"}
    schema = ", ".join(f"{n} {kinds[type(v)]}" for n, v in values.items())
    return spark.createDataFrame([row], schema).select(column.alias("x")).first().x if names else (
        spark.range(1).select(column.alias("x")).first().x
    )


def test_rounding_follows_the_double(spark):
    assert one(spark, Q.sql_round(F.lit(1.005), 2)) == 1.0
    assert one(spark, Q.sql_round(F.lit(2.5))) == 3.0
    assert one(spark, Q.sql_round(F.lit(-2.5))) == -3.0
    assert one(spark, Q.to_dec(F.lit(1.005), 10)) == Decimal("1.00")
    assert one(spark, Q.to_dec(F.lit(None).cast("double"), 10)) is None


def test_ratios_of_zero_are_null(spark):
    assert one(spark, Q.ratio(F.lit(5), F.lit(0))) is None
    assert one(spark, Q.pct(F.lit(1), F.lit(0))) is None
    assert one(spark, Q.pct(F.lit(1), F.lit(3))) == 33.33


def test_two_averages_of_the_same_money(spark):
    # Six amounts of 303163.155 on average: an exact tie at the third digit.
    df = spark.sql(
        "select cast(v as decimal(12,2)) v from values (319818.60), (257096.50), "
        "(151384.20), (401362.20), (383324.19), (305993.24) t(v)"
    )
    row = df.agg(
        Q.sql_round(Q.davg(F.col("v")), 2).alias("cents"),
        Q.sql_round(Q.quotient_avg(F.col("v")), 2).alias("quotient"),
    ).first()
    assert (row.cents, row.quotient) == (303163.16, 303163.15)
    assert df.where("false").agg(Q.quotient_avg(F.col("v")).alias("x")).first().x is None


def test_average_of_money(spark):
    df = spark.sql("select cast(v as decimal(12,2)) v from values (1.10), (2.25), (null) t(v)")
    assert df.agg(Q.davg(F.col("v")).alias("x")).first().x == 1.675
    assert df.where("false").agg(Q.davg(F.col("v")).alias("x")).first().x is None


@pytest.mark.parametrize("token", Q.NULL_TOKENS)
def test_null_tokens(spark, token):
    df = spark.createDataFrame([(token,)], "t string")
    assert df.select(Q.blank_to_null("t").alias("x")).first().x is None


def test_other_text_is_kept(spark):
    df = spark.createDataFrame([(" NA ",), ("nil",)], "t string")
    assert [r.x for r in df.select(Q.blank_to_null("t").alias("x")).collect()] == [" NA ", "nil"]


@pytest.mark.parametrize(
    "text, number, whole",
    [
        ("12", 12.0, 12),
        (" 12.50 ", 12.5, 12),
        ("13.5", 13.5, 14),
        ("-3", -3.0, -3),
        ("1e3", 1000.0, 1000),
        ("abc", None, None),
        ("1.0d", None, None),
        ("7F ", None, None),
        ("99999999999", 99999999999.0, None),
        ("", None, None),
    ],
)
def test_numbers(spark, text, number, whole):
    assert one(spark, Q.as_number(F.col("t")), t=text) == number
    assert one(spark, Q.as_whole_number(F.col("t")), t=text) == whole


@pytest.mark.parametrize(
    "text, flag",
    [("True", True), ("FALSE", False), (" false ", False), ("0", False), ("1", True), ("maybe", True)],
)
def test_flags(spark, text, flag):
    assert one(spark, Q.as_flag(F.col("t")), t=text) is flag


def test_missing_flag_is_true(spark):
    assert one(spark, Q.as_flag(F.lit(None).cast("string"))) is True


def test_timestamps(spark):
    read = Q.as_timestamp(F.col("t"))
    assert one(spark, read, t="2024-01-15T08:30:00") == dt.datetime(2024, 1, 15, 8, 30)
    assert one(spark, read, t="2024-01-15 08:30:00") == dt.datetime(2024, 1, 15, 8, 30)
    assert one(spark, read, t="2024-13-45") is None


def test_week_starts_on_sunday(spark):
    sunday, saturday = F.lit(dt.date(2024, 3, 17)), F.lit(dt.date(2024, 3, 16))
    assert (one(spark, Q.dow0(sunday)), one(spark, Q.dow0(saturday))) == (0, 6)
    assert one(spark, Q.is_weekend(sunday)) and one(spark, Q.is_weekend(saturday))
    assert not one(spark, Q.is_weekend(F.lit(dt.date(2024, 3, 18))))
    assert one(spark, Q.is_weekend(F.lit(None).cast("date"))) is False


def test_surrogate_keys(spark):
    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    missing = "_dbt_utils_surrogate_key_null_"
    assert one(spark, Q.surrogate_key(F.lit("P1"))) == md5("P1")
    assert one(spark, Q.surrogate_key(F.lit(None))) == md5(missing)
    assert one(spark, Q.surrogate_key(F.lit("a"), F.lit(None))) == md5(f"a-{missing}")


def test_infinite_numbers_are_unreadable(spark):
    text = ["Infinity", "-Infinity", "inf", "NaN", "1e400", " 2.5 "]
    rows = spark.createDataFrame([(t,) for t in text], "t string").select(Q.as_number(F.col("t")).alias("n"))
    assert [r.n for r in rows.collect()] == [None, None, None, None, None, 2.5]
