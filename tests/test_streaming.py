"""Structured Streaming front end: files landing in two waves, out of order."""

from __future__ import annotations

import datetime as dt
import os

from headway.sinks import tables as sinks
from headway.sources.gtfs_rt_proto import FeedMessage, enum_number
from headway.streaming.snapshots import start_alert_stream


def _alert_file(root, day, hour, minute, cause, ts):
    m = FeedMessage()
    m.header.gtfs_realtime_version = "2.0"
    m.header.timestamp = ts
    a = m.entity.add(id="A1").alert
    a.cause = enum_number("Cause", cause)
    a.severity_level = enum_number("SeverityLevel", "WARNING")
    a.active_period.add(start=ts)
    a.informed_entity.add(route_id="R1", stop_id="P1", route_type=3)
    d = os.path.join(root, "alerts", f"dt={day}", f"hour={hour:02d}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"snapshot_{day.replace('-', '')}_{hour:02d}{minute:02d}00.pb"), "wb") as f:
        f.write(m.SerializeToString())


def test_alert_stream_upserts_and_ignores_late_older_files(spark, tmpdir_path):
    landing, facts_root, ckpt = tmpdir_path + "/landing", tmpdir_path + "/facts", tmpdir_path + "/ckpt"
    versions = spark.createDataFrame([(dt.date(2024, 1, 1),)], "feed_start_date date")
    base = int(dt.datetime(2024, 1, 10, 15, 0, tzinfo=dt.timezone.utc).timestamp())
    _alert_file(landing, "2024-01-10", 10, 30, "WEATHER", base + 1800)
    q = start_alert_stream(spark, landing, versions, facts_root, ckpt, available_now=True)
    q.awaitTermination(300)
    # an older snapshot lands late: state must not regress
    _alert_file(landing, "2024-01-10", 10, 0, "STRIKE", base)
    q = start_alert_stream(spark, landing, versions, facts_root, ckpt, available_now=True)
    q.awaitTermination(300)
    rows = sinks.read_current(spark, facts_root + "/fact_alerts").collect()
    assert [(r.entity_id, r.cause, r.static_version_date) for r in rows] == [("A1", "WEATHER", dt.date(2024, 1, 1))]
    periods = sinks.read_current(spark, facts_root + "/fact_alerts_active_periods").collect()
    assert len(periods) == 1 and periods[0].active_start == dt.datetime(2024, 1, 10, 15, 30)
