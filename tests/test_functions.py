from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.functions import clean as C
from tallyline.functions import timeparts as T

from .conftest import d, ts


def test_null_tokens_and_units(spark):
    df = spark.createDataFrame(
        [("20km",), ("13.4 km",), ("10",), ("null",), ("NULL",), ("NaN",), ("",), (None,), ("abc",)], "x string")
    got = [r[0] for r in df.select(C.parse_number("x", C.DISTANCE_UNITS, "double")).collect()]
    assert got == [20.0, 13.4, 10.0, None, None, None, None, None, None]


def test_duration_units(spark):
    df = spark.createDataFrame([("32 minutes",), ("20 mins",), ("15minute",), ("25mins",), ("40",), ("null",)],
                               "x string")
    got = [r[0] for r in df.select(C.parse_number("x", C.DURATION_UNITS, "int")).collect()]
    assert got == [32, 20, 15, 25, 40, None]


def test_cancellation_tokens(spark):
    df = spark.createDataFrame([("",), ("null",), ("NaN",), (None,), ("Customer Cancellation",)], "x string")
    got = [r[0] for r in df.select(C.null_if_token("x", C.CANCELLATION_NULL_TOKENS)).collect()]
    assert got == [None, None, None, None, "Customer Cancellation"]


def test_id_lists(spark):
    df = spark.createDataFrame([("",), ("4",), ("2, 6",), ("1,5",), (None,), (" 3 , ",)], "x string")
    got = [r[0] for r in df.select(C.parse_id_list("x")).collect()]
    assert got == [[], [4], [2, 6], [1, 5], [], [3]]
    # splitting '' yields one blank element (kept by the row explode)
    assert df.select(C.split_tokens("x")).first()[0] == [""]


def test_signed_amount_unknown_type_is_credit(spark):
    df = spark.createDataFrame([("deposit", 5), ("purchase", 5), ("Withdrawal ", 5), ("fee", 5)],
                               "t string, a bigint")
    assert [r[0] for r in df.select(C.signed_amount("t", "a")).collect()] == [5, -5, -5, 5]


def test_boundary_minutes(spark):
    df = spark.createDataFrame([(ts("2021-01-01 18:05:02"), ts("2021-01-01 18:15:01")),
                                (ts("2021-01-08 23:59:59"), ts("2021-01-09 00:10:00"))], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(T.boundary_minutes("a", "b")).collect()] == [10, 11]


def test_weeks(spark):
    df = spark.createDataFrame([(d("2021-01-01"),), (d("2021-01-03"),), (d("2021-01-08"),), (d("2020-12-31"),)],
                               "x date")
    us = [r[0] for r in df.select(T.us_week("x")).collect()]
    assert us == [1, 2, 2, 53]
    anchored = [r[0] for r in df.select(T.anchored_week("x", "2021-01-01")).collect()]
    assert anchored == [1, 1, 2, 0]
    names = [r[0] for r in df.select(T.weekday_name(F.col("x"))).collect()]
    assert names == ["Friday", "Sunday", "Friday", "Thursday"]


def test_time_parts_do_not_depend_on_session_zone(spark):
    """1999-04-04 02:30 does not exist in New York (DST gap); zone-free values
    must not move when the session zone is changed."""
    from tallyline.operators import orders as O
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(ts("1999-04-04 01:55:00"), "1999-04-04 02:30:00")],
                                   "a timestamp_ntz, p string")
        r = df.select(T.boundary_minutes("a", C.parse_timestamp("p")).alias("m"),
                      C.parse_timestamp("p").cast("string").alias("p2"),
                      T.weekday_name("a").alias("w")).first()
        assert (r["m"], r["p2"], r["w"]) == (35, "1999-04-04 02:30:00", "Sunday")
        raw = spark.createDataFrame([(1, 1, "1999-04-04 02:30:00", "1km", "1", "")],
                                    "order_id bigint, runner_id int, pickup_time string, distance string, "
                                    "duration string, cancellation string")
        assert O.clean_deliveries(raw).first()["pickup_time"] == ts("1999-04-04 02:30:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
