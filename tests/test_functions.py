"""Column functions: literal edge cases."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from headway import functions as H


def _col(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_hms_to_seconds(spark):
    got = _col(spark, [("25:10:30",), ("00:00:00",), ("",), (None,), ("xx:10:00",)], "t string",
               H.hms_to_seconds("t"))
    assert got == [90630, 0, None, None, None]


def test_hms_hour(spark):
    assert _col(spark, [("24:05:00",), ("07:00:00",), (None,)], "t string", H.hms_hour("t")) == [24, 7, None]


def test_yyyymmdd(spark):
    got = _col(spark, [("20240115",), ("",), ("2024-13-01",), (None,)], "d string", H.yyyymmdd_to_date("d"))
    assert got == [dt.date(2024, 1, 15), None, None, None]


def test_minute_boundary_duration(spark):
    rows = [(dt.datetime(2024, 1, 1, 10, 0, 59), dt.datetime(2024, 1, 1, 10, 1, 0)),
            (dt.datetime(2024, 1, 1, 10, 0, 0), dt.datetime(2024, 1, 1, 12, 0, 0))]
    got = _col(spark, rows, "s timestamp_ntz, e timestamp_ntz", H.hours_by_minute_boundaries("s", "e"))
    assert got[0] == 1 / 60 and got[1] == 2.0


def test_on_time_bounds(spark):
    got = _col(spark, [(-151,), (-150,), (300,), (301,), (None,)], "d int", H.is_on_time("d"))
    assert got == [False, True, True, False, False]


def test_dst_conversion(spark):
    # 2026-03-08 06:59 and 07:00 UTC are 01:59 EST and 03:00 EDT
    e1 = int(dt.datetime(2026, 3, 8, 6, 59, tzinfo=dt.timezone.utc).timestamp())
    got = _col(spark, [(e1,), (e1 + 60,)], "e long", H.epoch_to_local_ntz("e"))
    assert got == [dt.datetime(2026, 3, 8, 1, 59), dt.datetime(2026, 3, 8, 3, 0)]


def test_epoch_utc_independent_of_session_tz(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        got = _col(spark, [(0,), (86399,)], "e long", H.epoch_to_utc_ntz("e"))
        assert got == [dt.datetime(1970, 1, 1), dt.datetime(1970, 1, 1, 23, 59, 59)]
        secs = _col(spark, [(dt.datetime(2024, 1, 2, 0, 0, 5),)], "t timestamp_ntz", H.ntz_epoch_seconds("t"))
        assert secs == [int(dt.datetime(2024, 1, 2, 0, 0, 5, tzinfo=dt.timezone.utc).timestamp())]
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_schedule_relationship(spark):
    got = _col(spark, [(" ",), (None,), ("ADDED",), ("",)], "r string", H.schedule_relationship("r"))
    assert got == ["SCHEDULED", "SCHEDULED", "ADDED", "SCHEDULED"]


def test_delivery_status(spark):
    rows = [(None, "CANCELED"), (True, "CANCELED"), (True, "ADDED"), (True, "SCHEDULED")]
    got = _col(spark, rows, "k boolean, r string", H.delivery_status("k", "r"))
    assert got == ["NO_RT_DATA", "CANCELED", "ADDED", "DELIVERED"]


def test_first_translation_text(spark):
    t = "struct<translation:array<struct<text:string,language:string>>>"
    df = spark.createDataFrame([({"translation": [{"text": "a", "language": "en"}]},), ({"translation": []},),
                                (None,)], f"x {t}")
    assert [r[0] for r in df.select(H.first_translation_text("x")).collect()] == ["a", None, None]


def test_overnight_window(spark):
    d = dt.date(2024, 1, 10)
    rows = [(d, 12), (d + dt.timedelta(days=1), 5), (d + dt.timedelta(days=1), 6), (d + dt.timedelta(days=2), 1)]
    df = spark.createDataFrame(rows, "service_date date, hour int").withColumn("trip_start_date", F.lit(d))
    got = [r[0] for r in df.select(H.in_overnight_window("service_date", "hour", "trip_start_date")).collect()]
    assert got == [True, True, False, False]


def test_not_deleted(spark):
    assert _col(spark, [(None,), (False,), (True,)], "x boolean", H.not_deleted("x")) == [True, True, False]


def test_seconds_since_day_start_past_midnight(spark):
    rows = [(dt.date(2024, 1, 1), dt.datetime(2024, 1, 2, 0, 30, 0))]
    got = _col(spark, rows, "d date, t timestamp_ntz", H.seconds_since_day_start("d", "t"))
    assert got == [86400 + 1800]


def test_weekday_flag(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 14), True, False), (dt.date(2024, 1, 15), True, False)],
                               "d date, sunday boolean, monday boolean")
    for name in ("tuesday", "wednesday", "thursday", "friday", "saturday"):
        df = df.withColumn(name, F.lit(None).cast("boolean"))
    got = [r[0] for r in df.select(H.weekday_flag("d", H.GTFS_WEEKDAY_COLUMNS)).collect()]
    assert got == [True, False]  # Sunday flag, then Monday flag


def test_first_translation_text_json(spark):
    rows = [('{"translation": [{"text": "a", "language": "en"}, {"text": "b"}]}',), ('{"translation": []}',), (None,)]
    assert _col(spark, rows, "x string", H.first_translation_text_json("x")) == ["a", None, None]
