"""Alert marts without day fan-out, the service metric's plan, and run days stored once."""

from __future__ import annotations

import datetime as dt
import random
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.operators import active_on_dates, daily_totals, union_of_days
from headway.plans import facts, marts
from headway.plans.model import TransitModel
from headway.plans.registry import registry
from headway.sinks import tables as sinks

SMALL = "/root/testdata/sf0.001"
D0 = dt.date(2024, 1, 1)


def _day(n):
    return D0 + dt.timedelta(days=n)


def _ts(n):
    return dt.datetime.combine(_day(n), dt.time(13, 30))


spans = st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 12), st.integers(-1, 5)), min_size=1, max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=spans)
def test_union_and_running_totals_equal_the_fan_out(spark, rows):
    iv = [(k, _day(a), _day(a + n)) for k, a, n in rows if n >= 0]
    days = spark.createDataFrame([(_day(i),) for i in range(0, 18) if i % 4 != 2], "alert_date date")
    df = spark.createDataFrame(iv, "k string, first_day date, last_day date")
    held = {}
    for k, a, b in iv:
        for n in range((b - a).days + 1):
            held[k, a + dt.timedelta(days=n)] = held.get((k, a + dt.timedelta(days=n)), 0) + 1
    wanted = {r.alert_date for r in days.collect()}
    got = {(r.k, r.alert_date): r.n for r in daily_totals(df.withColumn("n", F.lit(1)), ["k"], ["n"], days).collect()}
    assert got == {x: n for x, n in held.items() if x[1] in wanted}
    united = sorted((r.k, r.first_day, r.last_day) for r in union_of_days(df, ["k"]).collect())
    assert {(k, a + dt.timedelta(days=i)) for k, a, b in united for i in range((b - a).days + 1)} == set(held)
    assert all(k != k2 or (a2 - b).days > 1 for (k, _, b), (k2, a2, _) in zip(united, united[1:]))


def _alert_tables(spark, periods, informed, state):
    return (spark.createDataFrame(periods, "entity_id string, active_start timestamp_ntz, active_end timestamp_ntz"),
            spark.createDataFrame(informed, "entity_id string, route_id string, stop_id string, route_type int"),
            spark.createDataFrame(state, "entity_id string, severity_level string, static_version_date date"))


def test_alert_marts_equal_the_row_level_join(spark):
    rng = random.Random(4)
    periods = [(f"A{rng.randint(0, 9)}", _ts(a := rng.randint(0, 20)), rng.choice([None, _ts(a + rng.randint(-2, 9))])) for _ in range(60)]
    informed = [(f"A{rng.randint(0, 11)}", f"R{rng.randint(0, 3)}", f"P{rng.randint(0, 5)}", rng.choice([3, 3, 1])) for _ in range(80)]
    state = [(f"A{i}", rng.choice(["SEVERE", "WARNING", "INFO", None, "OTHER"]), D0) for i in range(12)]
    p, i, f = _alert_tables(spark, periods, informed, state)
    routes = spark.createDataFrame([(D0, f"R{n}", f"r{n % 3}", 3) for n in range(4)],
                                   "feed_start_date date, route_id string, route_short_name string, route_type int")
    stops = spark.createDataFrame([(D0, f"P{n}", f"stop {n % 3}", None if n == 4 else 42 + n / 7, -71 - n / 3) for n in range(6)],
                                  "feed_start_date date, stop_id string, stop_name string, stop_lat double, stop_lon double")
    days = [_day(n) for n in range(3, 25) if n != 9]
    frame = spark.createDataFrame([(d,) for d in days], "alert_date date")
    act = active_on_dates(p, frame, "active_start", "active_end").join(i.where("route_type = 3"), "entity_id").join(f, "entity_id")
    sev = [F.count_distinct("entity_id").alias("alert_count"),
           *[F.count_distinct(F.when(F.col("severity_level") == s.upper(), F.col("entity_id"))).alias(f"{s}_count") for s in marts.SEVERITIES]]
    key = lambda df, *c: sorted(map(str, df.select(*c).collect()))
    cols = ["alert_date", "route_id", "route_name", *marts.ALERT_COUNTS]
    want = act.join(routes.withColumnRenamed("route_short_name", "route_name").drop("route_type"), "route_id").groupBy(*cols[:3]).agg(*sev)
    assert key(marts.mart_alerts_by_day(p, i, f, routes, days), *cols) == key(want, *cols)
    cols = ["alert_date", "stop_name", "stop_lat", "stop_lon", *marts.ALERT_COUNTS]
    want = act.join(stops, "stop_id").groupBy("alert_date", "stop_name").agg(
        F.round(F.avg("stop_lat"), 9).alias("stop_lat"), F.round(F.avg("stop_lon"), 9).alias("stop_lon"), *sev)
    assert key(marts.mart_alerts_by_day_stops(p, i, f, stops, days), *cols) == key(want, *cols)


def _rows_made(df) -> int:
    """Most rows that any join or generator of the executed plan put out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    most = 0

    def walk(node):
        nonlocal most
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if re.search("Join|Generate", name):
            metric = node.metrics().get("numOutputRows")
            if metric.isDefined():
                most = max(most, metric.get().value())
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    walk(plan)
    return most


def test_a_long_alert_on_many_stops_makes_few_rows(spark):
    """10 000 days and 1 000 stops of two names: rows follow periods and stops, and the days of the result."""
    p, i, f = _alert_tables(spark, [("A", _ts(0), _ts(9_999)), ("A", _ts(10), _ts(20))],
                            [("A", "R1", f"P{n}", 3) for n in range(1_000)], [("A", "SEVERE", D0)])
    stops = spark.createDataFrame([(D0, f"P{n}", f"stop {n % 2}", 42.0, -71.0) for n in range(1_000)],
                                  "feed_start_date date, stop_id string, stop_name string, stop_lat double, stop_lon double")
    days = spark.range(10_000).select(F.date_add(F.lit(D0), F.col("id").cast("int")).alias("service_date"))
    out = marts.mart_alerts_by_day_stops(p, i, f, stops, run_days=days)
    assert _rows_made(out) <= 20_000 and out.count() == 20_000
    routes = spark.createDataFrame([(D0, "R1", "r", 3)], "feed_start_date date, route_id string, route_short_name string, route_type int")
    out = marts.mart_alerts_by_day(p, i, f, routes, run_days=days)
    assert _rows_made(out) <= 10_000 and out.agg(F.sum("severe_count")).first()[0] == 10_000


def test_service_metric_scans_events_for_raw_alone(spark):
    """RAW, run days and running services are stored; the metric's own plan scans tables and shuffles at most eight times."""
    m = TransitModel(spark, SMALL)
    df = m.mart_service_delivered
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in plan
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 8, plan
    assert len(re.findall(r"FileScan parquet", plan)) <= 10
    assert "events.parquet" not in m.scheduled_bus_trips._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in m.mart_alerts_by_day._jdf.queryExecution().executedPlan().toString()


def test_added_trips_count_under_their_own_route_and_scheduled_ones_leave(spark):
    day = D0
    sched = spark.createDataFrame([(day, day, f"T{i}", "R1", "one", 0 if i < 3 else None, day) for i in range(5)],
                                  "service_date date, trip_start_date date, trip_id string, route_id string, route_name string, "
                                  "direction_id int, static_version_date date")
    tu = spark.createDataFrame([(day, "T0", "R1", 0, day, "SCHEDULED"), (day, "T1", "R1", 0, day, "ADDED"), (day, "T2", "R1", 0, day, "CANCELED"),
                                (day, "X1", "R1", 0, day, "ADDED"), (day, "X2", "R1", None, day, "ADDED"), (day, "X3", "R9", 0, day, "ADDED")],
                               "trip_start_date date, trip_id string, route_id string, direction_id int, static_version_date date, "
                               "trip_schedule_rel string")
    got = sorted((str(r.direction_id), r.scheduled_trips, r.delivered_trips, r.canceled_trips, r.no_rt_data_trips, r.added_trips)
                 for r in marts.mart_service_delivered(sched, tu).collect())
    assert got == [("0", 2, 1, 1, 0, 2), ("None", 2, 0, 0, 2, 1)]


def _exploded_stop_times(spark, trips: int):
    """Five stops per trip, made by exploding a small table (whose size the planner keeps as its estimate)."""
    return spark.range(trips).select(F.lit(D0).alias("feed_start_date"), F.concat(F.lit("T"), F.col("id")).alias("trip_id"),
                                     F.explode(F.sequence(F.lit(1), F.lit(5))).alias("stop_sequence")).select(
        "*", F.lit("08:00:00").alias("arrival_time"), F.lit("08:00:00").alias("departure_time"), F.lit(28_800).alias("arrival_seconds"))


def test_stop_times_meet_stop_events_by_shuffle(spark):
    """The largest dimension is not sent whole to the driver and every task, however small its estimate."""
    stopped = _ts(0)
    fact = spark.createDataFrame(
        [(D0, D0, 8, "T1", "R1", "P1", 2, stopped, "1", "STOPPED_AT", None, None, D0)],
        "service_date date, trip_start_date date, hour int, trip_id string, route_id string, stop_id string, current_stop_sequence int, "
        "position_timestamp timestamp_ntz, entity_id string, current_status string, occupancy_status string, "
        "occupancy_percentage int, static_version_date date")
    routes = spark.createDataFrame([(D0, "R1", "one", 3)], "feed_start_date date, route_id string, route_short_name string, route_type int")
    out = marts.mart_stop_events(fact, _exploded_stop_times(spark, 100), routes)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[trip_id#\d+, stop_sequence#", plan), plan
    assert [(r.trip_id, r.stop_sequence, r.scheduled_arrival_seconds) for r in out.collect()] == [("T1", 2, 28_800)]


def _folder(spark, path, events, customers, suppliers=(4,)):
    """Driver tables of a few own rows, one file each."""
    when = "timestamp_ntz"
    for name, rows, ddl in (("events", events, f"event_id bigint, ts {when}, user_id bigint, event_type string, value double, props string"),
                            ("customer", [(n,) for n in customers], "c_custkey bigint"),
                            ("supplier", [(n,) for n in suppliers], "s_suppkey bigint"),
                            ("orders", [(4, dt.datetime(1995, 1, 1))], f"o_custkey bigint, o_orderdate {when}")):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return path


def test_trip_fact_and_service_metric_see_every_poll(spark, tmpdir_path):
    """Five polls of an hour, the trip canceled in the last: RAW as loaded keeps the first poll alone."""
    polls = [(i, dt.datetime(2024, 1, 10, 10, i), 4, "error" if i == 4 else "purchase", 1.0, '{"k": 5}') for i in range(5)]
    folder = _folder(spark, tmpdir_path, polls, [4])
    q = registry()
    assert [(r.trip_id, r.entity_id, r.trip_schedule_rel) for r in q["fact_trip_updates"](spark, folder).collect()] == [("T4", "4", "CANCELED")]
    assert [(r.scheduled_trips, r.delivered_trips, r.canceled_trips) for r in q["mart_service_delivered"](spark, folder).collect()] == [(1, 0, 1)]
    assert [r.canceled_trips for r in q["report_service_delivered_daily"](spark, folder).select("canceled_trips").collect()] == [1]
    assert [r.canceled_trips for r in q["report_service_range"](spark, folder).select("canceled_trips").collect()] == [1]


def test_service_sink_sees_every_poll(spark, tmpdir_path):
    """As above, two days: the replaced table has the metric of every poll, not that of the fifth polls."""
    polls = [(10 * d + i, dt.datetime(2024, 1, d, 10, i), 4, "error" if i == 4 and d == 10 else "purchase", 1.0, '{"k": 5}')
             for d in (10, 11) for i in range(5)]
    folder = _folder(spark, tmpdir_path, polls, [4])
    q = registry()
    rows = q["sink_service_delivered"](spark, folder)
    mart = q["mart_service_delivered"](spark, folder)
    assert rows.columns == mart.columns
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, mart.collect()))
    assert [(r.trip_start_date.day, r.delivered_trips, r.canceled_trips) for r in rows.orderBy("trip_start_date").collect()] == [(10, 0, 1), (11, 1, 0)]


def test_trips_and_stop_times_of_one_small_file_are_made_in_many_tasks(spark, tmpdir_path):
    """A key file of one split: its rows are dealt over tasks before they are multiplied, and no task holds most of them."""
    polls = [(1, dt.datetime(2024, 1, 10, 10, 0), 4, "purchase", 1.0, '{"k": 5}')]
    m = TransitModel(spark, _folder(spark, tmpdir_path, polls, range(2_000)), every_poll=True)
    for made, rows in ((m.t.dim_stop_times, 30_000), (m.t.dim_trips, 6_000)):
        counts = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(counts) == rows and max(counts) < rows / 4, counts
    plan = m.scheduled_bus_trips._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[feed_start_date#\d+, trip_id#\d+\]", plan), plan
    # the metric's rows of single trips are hashed, not sorted, when they are counted
    plan = m.mart_service_delivered._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"HashAggregate\(keys=\[trip_start_date#.*functions=\[partial_sum\(scheduled_trips", plan), plan
    assert not re.search(r"SortAggregate\(.*partial_sum\(x", plan)


def test_written_stop_events_meet_stop_times_by_shuffle(spark, tmpdir_path, monkeypatch):
    """The reports and the sink write the mart first: what they write sends no stop times to the driver either."""
    polls = [(1, dt.datetime(2024, 1, 15, 10, 0), 4, "view", 1.0, '{"k": 6}')]
    folder = _folder(spark, tmpdir_path, polls, [4])
    written, clustered = [], sinks.clustered

    def noted(df, *columns):
        out = clustered(df, *columns)
        written.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(sinks, "clustered", noted)
    q = registry()
    for name in ("report_otp_daily", "report_otp_day", "report_otp_hourly", "report_worst_otp_routes", "sink_stop_events"):
        del written[:]
        assert len(q[name](spark, folder).collect()) == (name != "report_worst_otp_routes")     # which asks for more events
        assert written, name
        for plan in written:
            joins = re.findall(r"(\w+Join) \[trip_id#\d+, stop_sequence#", plan)
            assert joins and set(joins) == {"SortMergeJoin"}, (name, plan)


def test_trips_stay_dealt_when_they_meet(spark, tmpdir_path):
    """Adaptive execution merges small shuffled partitions, here into one: the joins' rows were asked to stay dealt."""
    polls = [(1, dt.datetime(2024, 1, 10, 10, 0), 4, "purchase", 1.0, '{"k": 5}')]
    m = TransitModel(spark, _folder(spark, tmpdir_path, polls, range(2_000)), every_poll=True)
    counts = [r["count"] for r in m.scheduled_bus_trips.groupBy(F.spark_partition_id()).count().collect()]
    # of 200 trips of the bus route, 40 first leave after midnight
    assert sum(counts) == 160 and max(counts) < 160 / 3, counts
    plan = m.mart_service_delivered._jdf.queryExecution().executedPlan().toString()
    asked = r"Exchange hashpartitioning\(%s, \d+\), REPARTITION_BY_NUM"
    assert re.search(asked % r"trip_id#\d+, trip_start_date#\d+, static_version_date#\d+", plan), plan
    assert re.search(asked % r"feed_start_date#\d+, trip_id#\d+", plan), plan


def test_snapshot_rows_of_one_split_are_sorted_in_many_tasks(spark, tmpdir_path, monkeypatch):
    """Every poll in one file with one row group, all of one trip: the step that keeps the newest row gets them dealt."""
    polls = [(i, dt.datetime(2024, 1, 10, 10, 0) + dt.timedelta(seconds=i), 4, "error" if i == 1_999 else "purchase", 1.0, '{"k": 5}')
             for i in range(2_000)]
    folder = _folder(spark, tmpdir_path, polls, [4])
    sorted_rows, latest = [], facts.latest_per_key

    def noted(df, *args, **kwargs):
        sorted_rows.append([r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()])
        return latest(df, *args, **kwargs)

    monkeypatch.setattr(facts, "latest_per_key", noted)
    q = registry()
    assert [r.delivered_trips for r in q["report_service_delivered_daily"](spark, folder).select("delivered_trips").collect()] == [0]
    assert [r.canceled_trips for r in q["report_service_range"](spark, folder).select("canceled_trips").collect()] == [1]
    assert len(sorted_rows) == 2
    for counts in sorted_rows:
        assert sum(counts) == 2_000 and max(counts) < 2_000 / 3, counts
