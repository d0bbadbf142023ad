"""Operators and builders on literal fixtures (semantic edges)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from headway import operators as O
from headway.plans import facts, marts, reports
from headway.sinks import tables as sinks

D = dt.date
T = dt.datetime


def test_asof_version(spark):
    versions = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 10),)], "feed_start_date date")
    dates = spark.createDataFrame([(D(2023, 12, 31),), (D(2024, 1, 1),), (D(2024, 1, 9),), (D(2024, 1, 10),),
                                   (D(2024, 3, 1),)], "d date")
    got = {r.d: r.static_version_date for r in O.asof_version(dates, "d", versions).collect()}
    assert got == {D(2023, 12, 31): None, D(2024, 1, 1): D(2024, 1, 1), D(2024, 1, 9): D(2024, 1, 1),
                   D(2024, 1, 10): D(2024, 1, 10), D(2024, 3, 1): D(2024, 1, 10)}


def test_upsert_guard(spark):
    target = spark.createDataFrame([("a", 5, "t"), ("b", 5, "t"), ("c", 5, "t"), ("d", 5, "t")], "k string, ts int, v string")
    source = spark.createDataFrame([("a", 4, "s"), ("b", 5, "s"), ("c", 6, "s"), ("e", 1, "s")], "k string, ts int, v string")
    got = {r.k: (r.ts, r.v) for r in O.upsert_latest(target, source, ["k"], "ts").collect()}
    assert got == {"a": (5, "t"), "b": (5, "t"), "c": (6, "s"), "d": (5, "t"), "e": (1, "s")}


def test_upsert_null_timestamps_keep_target(spark):
    target = spark.createDataFrame([("a", None), ("b", 3)], "k string, ts int")
    source = spark.createDataFrame([("a", 9), ("b", None)], "k string, ts int")
    got = {r.k: r.ts for r in O.upsert_latest(target, source, ["k"], "ts").collect()}
    assert got == {"a": None, "b": 3}


def test_backfill_order_independent(spark, tmpdir_path):
    days = {1: [("a", T(2024, 1, 1, 8)), ("b", T(2024, 1, 1, 9))],
            2: [("a", T(2024, 1, 2, 8))],
            3: [("b", T(2024, 1, 3, 7)), ("c", T(2024, 1, 3, 1))]}

    def apply(order, path):
        for d in order:
            src = spark.createDataFrame(days[d], "entity_id string, snapshot_timestamp timestamp_ntz") \
                .withColumn("day", F.lit(d))
            sinks.upsert_table(src, path, ["entity_id"])
        return sorted(tuple(r) for r in sinks.read_current(spark, path).collect())

    assert apply([1, 2, 3], tmpdir_path + "_a") == apply([3, 1, 2], tmpdir_path + "_b")


def test_collapse_slices_equal_ts_earliest_slice_wins(spark):
    src = spark.createDataFrame([("a", 5, 2, "later"), ("a", 5, 1, "earlier")], "k string, ts int, day int, v string")
    got = O.collapse_slices(src, ["k"], "ts", "day").collect()
    assert [r.v for r in got] == ["earlier"]


def test_replace_empty_slice(spark, tmpdir_path):
    df = spark.createDataFrame([(D(2024, 1, 1), 1), (D(2024, 1, 2), 2)], "day date, x int")
    sinks.write_table(df, tmpdir_path, ["day"])
    sinks.replace_days(df.where(F.lit(False)), tmpdir_path, "day", [D(2024, 1, 2)])
    back = sinks.read_table(spark, tmpdir_path, "x int, day date").collect()
    assert [(r.day, r.x) for r in back] == [(D(2024, 1, 1), 1)]


def test_replace_slice_idempotent(spark, tmpdir_path):
    df = spark.createDataFrame([(D(2024, 1, 1), 1), (D(2024, 1, 2), 2)], "day date, x int")
    sinks.write_table(df, tmpdir_path, ["day"])
    new = spark.createDataFrame([(D(2024, 1, 2), 7)], "day date, x int")
    for _ in range(2):
        sinks.replace_days(new, tmpdir_path, "day", [D(2024, 1, 2)])
    back = sorted((r.day, r.x) for r in sinks.read_table(spark, tmpdir_path, "x int, day date").collect())
    assert back == [(D(2024, 1, 1), 1), (D(2024, 1, 2), 7)]


def test_active_on_dates(spark):
    d = D(2024, 1, 10)
    rows = [("end_midnight", T(2024, 1, 5), T(2024, 1, 10, 0, 0)),
            ("start_late", T(2024, 1, 10, 23, 59), T(2024, 1, 20)),
            ("open", T(2024, 1, 1), None),
            ("ended", T(2024, 1, 1), T(2024, 1, 9, 23, 59))]
    iv = spark.createDataFrame(rows, "id string, s timestamp_ntz, e timestamp_ntz")
    days = spark.createDataFrame([(d,)], "alert_date date")
    got = sorted(r.id for r in O.active_on_dates(iv, days, "s", "e").collect())
    assert got == ["end_midnight", "open", "start_late"]


def _raw_alert(spark, periods):
    schema = ("service_date date, entity_id string, snapshot_timestamp timestamp_ntz, is_deleted boolean, "
              "active_period array<struct<start:bigint,end:bigint>>")
    rows = [(D(2024, 1, 1), f"A{i}", T(2024, 1, 1, 1), False, p) for i, p in enumerate(periods)]
    return spark.createDataFrame(rows, schema)


def test_active_period_arrays(spark):
    ra = _raw_alert(spark, [None, [], [(100, None)], [(100, 200), (300, 400)]])
    got = facts.fact_alerts_active_periods(ra).groupBy("entity_id").count().collect()
    assert {r.entity_id: r[1] for r in got} == {"A2": 1, "A3": 2}


def test_first_event_nulls_last(spark):
    df = spark.createDataFrame([("t", None, "x"), ("t", T(2024, 1, 1, 10), "y")], "k string, ts timestamp_ntz, v string")
    assert [r.v for r in O.earliest_per_key(df, ["k"], "ts").collect()] == ["y"]


def test_stride_sample(spark):
    files = spark.createDataFrame([(f"f{i:02d}", 1) for i in range(12)], "path string, hour int")
    assert sorted(r.path for r in O.stride_sample(files, ["hour"], "path", 5).collect()) == ["f00", "f05", "f10"]


def test_numeric_first_sort(spark):
    df = spark.createDataFrame([("SL1",), ("10",), ("9",), ("CT2",)], "route_name string")
    got = [r.route_name for r in df.orderBy(*O.numeric_first_order("route_name")).collect()]
    assert got == ["9", "10", "CT2", "SL1"]


def test_weighted_mean_null_aware(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 0, "R1", "1", 2, 50.0), (D(2024, 1, 1), 1, "R1", "1", 8, None)],
                               "service_date date, hour int, route_id string, route_name string, snapshot_count long, "
                               "avg_occupancy_pct double")
    for c in ("pct_empty", "pct_many_seats", "pct_few_seats", "pct_standing_room", "pct_crushed_standing",
              "pct_full", "pct_no_data_occupancy"):
        df = df.withColumn(c, F.lit(0.0))
    r = reports.occupancy_trend(df, bucket="service_date").collect()[0]
    assert r.avg_occupancy_pct == 50.0 and r.snapshot_count == 10


def test_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), "R1", "1", 0, 0, 0, 0, 0)],
                               "trip_start_date date, route_id string, route_name string, scheduled_trips long, "
                               "delivered_trips long, canceled_trips long, no_rt_data_trips long, added_trips long")
    r = reports.service_delivered_daily(df).collect()[0]
    assert r.pct_delivered is None and r.pct_added is None


def test_calendar_exceptions(spark):
    v = D(2024, 1, 1)
    versions = spark.createDataFrame([(v,)], "feed_start_date date")
    day = D(2024, 1, 15)  # a Monday
    flags = "monday boolean, tuesday boolean, wednesday boolean, thursday boolean, friday boolean, saturday boolean, sunday boolean"
    cal = spark.createDataFrame(
        [(v, "WD_REMOVED", True, True, True, True, True, False, False, D(2024, 1, 1), D(2024, 12, 31)),
         (v, "WE_ADDED", False, False, False, False, False, True, True, D(2024, 1, 1), D(2024, 12, 31)),
         (v, "BOTH", False, False, False, False, False, False, False, D(2024, 1, 1), D(2024, 12, 31))],
        f"feed_start_date date, service_id string, {flags}, start_date date, end_date date")
    cd = spark.createDataFrame([(v, "WD_REMOVED", day, 2), (v, "WE_ADDED", day, 1), (v, "BOTH", day, 1),
                                (v, "BOTH", day, 2)],
                               "feed_start_date date, service_id string, date date, exception_type int")
    days = spark.createDataFrame([(day,)], "trip_start_date date")
    got = [r.service_id for r in marts.active_services(cal, cd, versions, days).collect()]
    assert got == ["WE_ADDED"]


def test_added_trips_null_direction(spark):
    v, d = D(2024, 1, 1), D(2024, 1, 2)
    sched = spark.createDataFrame([(d, d, "T1", "R1", "1", None, v)],
                                  "service_date date, trip_start_date date, trip_id string, route_id string, "
                                  "route_name string, direction_id int, static_version_date date")
    tu = spark.createDataFrame([("T1", d, "R1", None, v, None), ("X1", d, "R1", None, v, "ADDED")],
                               "trip_id string, trip_start_date date, route_id string, direction_id int, "
                               "static_version_date date, trip_schedule_rel string")
    r = marts.mart_service_delivered(sched, tu).collect()[0]
    assert (r.scheduled_trips, r.delivered_trips, r.added_trips, r.pct_delivered) == (1, 1, 1, 100.0)


def test_multi_date_build_equals_union_of_single_days(spark):
    """PAR-4: one job over a set of days gives the union of the per-day jobs."""
    from headway.plans.model import TransitModel

    m = TransitModel(spark, "/root/testdata/sf0.001")
    days = ["2024-01-05", "2024-01-06", "2024-01-07"]
    vp, versions, routes = m.t.raw_vehicle_positions, m.t.dim_static_versions, m.t.dim_routes

    fact = facts.fact_vehicle_positions(vp, versions)  # the fact table holds every trip day

    def occ(ds):
        return marts.mart_occupancy_route_hour(fact, routes, ds)

    together = sorted(tuple(r) for r in occ(days).collect())
    apart = sorted(tuple(r) for d in days for r in occ([d]).collect())
    assert together == apart and len(together) > 0
    tu_all = facts.fact_trip_updates(m.t.raw_trip_updates, versions, days)
    tu_one = [facts.fact_trip_updates(m.t.raw_trip_updates, versions, [d]) for d in days]
    assert sorted(tuple(r) for r in tu_all.collect()) == sorted(tuple(r) for df in tu_one for r in df.collect())


def test_report_filters_and_buckets(spark):
    occ = spark.createDataFrame(
        [(D(2024, 1, 1), 5, "R1", "1", 4, 10.0), (D(2024, 1, 1), 6, "R2", "SL2", 4, 30.0),
         (D(2024, 1, 2), 5, "R1", "1", 4, 50.0)],
        "service_date date, hour int, route_id string, route_name string, snapshot_count long, avg_occupancy_pct double")
    for c in ("pct_empty", "pct_many_seats", "pct_few_seats", "pct_standing_room", "pct_crushed_standing",
              "pct_full", "pct_no_data_occupancy"):
        occ = occ.withColumn(c, F.lit(0.0))
    one_day = reports.occupancy_trend(occ, "2024-01-01", "2024-01-01", routes=["1"]).collect()
    assert [(r.bucket, r.avg_occupancy_pct) for r in one_day] == [(5, 10.0)]  # hour buckets, route filter
    days = sorted(tuple(r)[:2] for r in reports.occupancy_trend(occ, "2024-01-01", "2024-01-02").collect())
    assert days == [(D(2024, 1, 1), 8), (D(2024, 1, 2), 4)]
    assert [r.route_name for r in reports.route_list(occ).collect()] == ["1", "SL2"]


def test_lagged_run_day():
    from headway.plans._common import lagged_day

    assert lagged_day("2024-03-03", 2) == D(2024, 3, 1)


def test_asof_duplicate_versions(spark):
    versions = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 1),), (D(2024, 1, 3),)], "feed_start_date date")
    days = sorted((r.feed_start_date, r[1]) for r in O.version_days(versions).collect())
    assert days == [(D(2024, 1, 1), D(2024, 1, 1)), (D(2024, 1, 1), D(2024, 1, 2)), (D(2024, 1, 3), D(2024, 1, 3))]


def test_daily_total_scale(spark):
    daily = spark.createDataFrame([(D(2024, 1, 1), 3, 4, 5), (D(2024, 1, 2), 30, 40, 31)],
                                  "alert_date date, severe_count long, warning_count long, info_count long")
    r = reports.daily_total_scale(daily).collect()[0]
    assert (r.max_daily_total, r.tick_step) == (101, 11)
    r = reports.daily_total_scale(daily, ["SEVERE"]).collect()[0]
    assert (r.max_daily_total, r.tick_step) == (30, 3)
