"""End to end over a warehouse folder: landed GTFS + realtime files -> RAW -> DIM -> FACT -> MART,
then an idempotent re-run."""

from __future__ import annotations

import datetime as dt
import os

from headway.plans import daily
from headway.sources.gtfs_rt_proto import FeedMessage, enum_number

DAY = "2024-01-10"


def _utc(h, m, s=0):  # Eastern wall clock 2024-01-10 (EST, UTC-5) -> epoch
    return int(dt.datetime(2024, 1, 10, h + 5, m, s, tzinfo=dt.timezone.utc).timestamp())


def _w(path, data, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as f:
        f.write(data)


def _land(root):
    g = f"{root}/gtfs/v_20240101_060000"
    _w(f"{g}/feed_info.txt", "feed_publisher_name,feed_start_date,feed_end_date\nX,20240101,20241231\n")
    _w(f"{g}/routes.txt", "route_id,route_short_name,route_type\nR1,1,3\nR9,9,1\n")
    _w(f"{g}/stops.txt", "stop_id,stop_name,stop_lat,stop_lon\nP1,First,42.1,-71.1\nP2,Second,42.2,-71.2\nP3,Third,42.3,-71.3\n")
    _w(f"{g}/trips.txt", "route_id,service_id,trip_id,direction_id\nR1,S1,T1,0\n")
    _w(f"{g}/stop_times.txt", "trip_id,arrival_time,departure_time,stop_id,stop_sequence\n"
                              "T1,08:00:00,08:00:00,P1,1\nT1,08:10:00,08:10:00,P2,2\nT1,08:20:00,08:20:00,P3,3\n")
    _w(f"{g}/calendar.txt", "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\n"
                            "S1,1,1,1,1,1,1,1,20240101,20241231\n")
    rt = f"{root}/rt"
    for minute, sec, seq, stop, occ in ((9, 50, 2, "P2", 40), (21, 0, 3, "P3", 60)):
        m = FeedMessage()
        m.header.gtfs_realtime_version, m.header.timestamp = "2.0", _utc(8, minute, sec)
        v = m.entity.add(id=f"v{seq}").vehicle
        v.trip.trip_id, v.trip.route_id, v.trip.start_date = "T1", "R1", "20240110"
        v.current_stop_sequence, v.stop_id = seq, stop
        v.current_status = enum_number("VehicleStopStatus", "STOPPED_AT")
        v.occupancy_percentage, v.timestamp = occ, _utc(8, minute, sec)
        _w(f"{rt}/vehicle_positions/dt={DAY}/hour=08/snapshot_20240110_08{minute:02d}{sec:02d}.pb",
           m.SerializeToString(), "wb")
    m = FeedMessage()
    m.header.gtfs_realtime_version, m.header.timestamp = "2.0", _utc(8, 30)
    t = m.entity.add(id="u1").trip_update
    t.trip.trip_id, t.trip.route_id, t.trip.start_date, t.trip.direction_id = "T1", "R1", "20240110", 0
    _w(f"{rt}/trip_updates/dt={DAY}/hour=08/snapshot_20240110_083000.pb", m.SerializeToString(), "wb")
    m = FeedMessage()
    m.header.gtfs_realtime_version, m.header.timestamp = "2.0", _utc(7, 0)
    a = m.entity.add(id="A1").alert
    a.severity_level = enum_number("SeverityLevel", "WARNING")
    a.active_period.add(start=_utc(0, 0))
    a.informed_entity.add(route_id="R1", stop_id="P2", route_type=3)
    _w(f"{rt}/alerts/dt={DAY}/hour=07/snapshot_20240110_070000.pb", m.SerializeToString(), "wb")
    return f"{root}/gtfs", rt


def _run(wh, gtfs, rt):
    daily.load_static(wh, gtfs)
    for feed in ("vehicle_positions", "trip_updates", "alerts"):
        daily.load_realtime(wh, rt, feed, [DAY])
    daily.build_facts(wh, [DAY])
    daily.build_marts(wh, [DAY])


def _snap(wh):
    tables = ("metric_stop_events", "metric_occupancy_route_hour", "metric_alerts_by_day",
              "metric_alerts_by_day_stops", "metric_service_delivered", "fact_alerts")
    return {t: sorted(tuple(x for x in r if not isinstance(x, dt.datetime) or t != "fact_alerts")
                      for r in wh.read(t).drop("ingested_at" if t == "fact_alerts" else "_none").collect())
            for t in tables}


def test_daily_jobs_end_to_end(spark, tmpdir_path):
    gtfs, rt = _land(tmpdir_path + "/landing")
    wh = daily.Warehouse(spark, tmpdir_path + "/warehouse")
    _run(wh, gtfs, rt)

    se = {r.stop_sequence: r for r in wh.read("metric_stop_events").collect()}
    assert set(se) == {2, 3}
    assert (se[2].arrival_delay_seconds, se[2].is_on_time) == (-10, True)
    assert (se[3].arrival_delay_seconds, se[3].is_on_time) == (60, True)
    occ = wh.read("metric_occupancy_route_hour").collect()
    assert [(r.hour, r.route_id, r.route_name, r.snapshot_count, r.avg_occupancy_pct) for r in occ] == \
        [(8, "R1", "1", 2, 50.0)]
    al = wh.read("metric_alerts_by_day").collect()
    assert [(r.route_id, r.alert_count, r.warning_count) for r in al] == [("R1", 1, 1)]
    st = wh.read("metric_alerts_by_day_stops").collect()
    assert [(r.stop_name, r.alert_count) for r in st] == [("Second", 1)]
    svc = wh.read("metric_service_delivered").collect()
    assert [(r.route_id, r.scheduled_trips, r.delivered_trips, r.pct_delivered) for r in svc] == [("R1", 1, 1, 100.0)]

    before = _snap(wh)
    _run(wh, gtfs, rt)  # re-running the same day replaces the same slices
    assert _snap(wh) == before


def _sets(wh, table):
    from headway.sinks import tables as sinks

    m = sinks.current_manifest(wh.spark, wh.path(table))
    return dict(m.slices) if m else {}


def _position(rt, day, hour, n, occ):
    """One poll of day ``day`` (trip of that day) at ``hour``."""
    d = dt.date.fromisoformat(day)
    m = FeedMessage()
    m.header.gtfs_realtime_version = "2.0"
    m.header.timestamp = int(dt.datetime(d.year, d.month, d.day, hour + 5, n, tzinfo=dt.timezone.utc).timestamp())
    v = m.entity.add(id=f"v{n}").vehicle
    v.trip.trip_id, v.trip.route_id, v.trip.start_date = "T1", "R1", d.strftime("%Y%m%d")
    v.current_stop_sequence, v.stop_id, v.occupancy_percentage, v.timestamp = 2, "P2", occ, m.header.timestamp
    v.current_status = enum_number("VehicleStopStatus", "STOPPED_AT")
    _w(f"{rt}/vehicle_positions/dt={day}/hour={hour:02d}/snapshot_{d:%Y%m%d}_{hour:02d}{n:02d}00.pb", m.SerializeToString(), "wb")


def test_runs_build_what_became_due_and_what_late_slices_touch(spark, tmpdir_path):
    gtfs, rt = _land(tmpdir_path + "/landing")
    for day in ("2024-01-08", "2024-01-09", "2024-01-11", "2024-01-12"):
        _position(rt, day, 9, 1, 30)
    wh = daily.Warehouse(spark, tmpdir_path + "/warehouse")
    d = lambda n: dt.date(2024, 1, n)
    plan = daily.run(wh, rt, gtfs, "2024-01-10")                       # loads the 9th, builds the 8th
    assert plan.trip_days == (d(8),) and plan.service_days == (d(8),)
    plan = daily.run(wh, rt, gtfs, "2024-01-11")                       # loads the 10th, builds the 9th
    assert plan.trip_days == (d(9),)
    assert [r.service_date for r in wh.read("metric_occupancy_route_hour").collect()] == [d(9)]
    plan = daily.run(wh, rt, gtfs, "2024-01-14")                       # two runs were missed: their days come too
    assert set(plan.trip_days) == {d(10), d(11), d(12)}
    occupancy = {r.service_date: r.avg_occupancy_pct for r in wh.read("metric_occupancy_route_hour").collect()}
    assert set(occupancy) == {d(9), d(10), d(11), d(12)} and occupancy[d(11)] == 30
    before = {t: _sets(wh, t) for t in ("fact_vehicle_positions", "metric_stop_events", "metric_occupancy_route_hour")}
    _position(rt, "2024-01-11", 10, 2, 90)                             # lands late, and its RAW slice is loaded again
    daily.load_realtime(wh, rt, "vehicle_positions", ["2024-01-11"])
    plan = daily.plan_run(wh, "2024-01-14")
    assert plan.trip_days == (d(10), d(11)) and plan.service_days == (d(11),) and plan.alert_days == ()
    daily.build_facts(wh, plan.trip_days, plan.alert_days)
    daily.build_marts(wh, plan.trip_days, plan.service_days, plan.alert_days)
    changed = {t: {k for k in {*before[t], *_sets(wh, t)} if before[t].get(k) != _sets(wh, t).get(k)} for t in before}
    assert changed["fact_vehicle_positions"] == {"trip_start_date=2024-01-10", "trip_start_date=2024-01-11"}
    assert changed["metric_occupancy_route_hour"] == {"service_date=2024-01-11"}
    occ = [(r.hour, r.avg_occupancy_pct) for r in wh.read("metric_occupancy_route_hour").where("service_date = '2024-01-11'").collect()]
    assert sorted(occ) == [(9, 30), (10, 90)]
