"""Realtime feed snapshots: real protobuf files in the landing layout, read with binaryFile."""

from __future__ import annotations

import datetime as dt
import os

from headway.plans import raw
from headway.sources import gtfs_rt
from headway.sources.gtfs_rt_proto import FeedMessage, enum_number


def _epoch(y, mo, d, h, mi, s=0):
    return int(dt.datetime(y, mo, d, h, mi, s, tzinfo=dt.timezone.utc).timestamp())


def _write(root, feed, day, hour, name, msg):
    d = os.path.join(root, feed, f"dt={day}", f"hour={hour:02d}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "wb") as f:
        f.write(msg.SerializeToString())


class _Broken:
    def SerializeToString(self):
        return b"\xff\xff"


def _feed(ts):
    m = FeedMessage()
    m.header.gtfs_realtime_version = "2.0"
    m.header.timestamp = ts
    return m


def test_vehicle_positions_from_files(spark, tmpdir_path):
    root = tmpdir_path
    # 2024-01-10 10:00:00 UTC = 05:00 Eastern
    m = _feed(_epoch(2024, 1, 10, 10, 0))
    e = m.entity.add(id="v1")
    v = e.vehicle
    v.trip.trip_id, v.trip.route_id, v.trip.start_date = "T1", "R1", "20240110"
    v.trip.schedule_relationship = enum_number("ScheduleRelationship", "SCHEDULED")
    v.vehicle.id, v.vehicle.label = "y1", "1001"
    v.position.latitude, v.position.longitude = 42.25, -71.5
    v.current_stop_sequence, v.stop_id = 3, "P3"
    v.current_status = enum_number("VehicleStopStatus", "STOPPED_AT")
    v.occupancy_status = enum_number("OccupancyStatus", "FULL")
    v.timestamp = _epoch(2024, 1, 10, 9, 59, 30)
    c = v.multi_carriage_details.add(id="c1", carriage_sequence=1)
    c.occupancy_status = enum_number("OccupancyStatus", "EMPTY")
    m.entity.add(id="a1").alert.cause = enum_number("Cause", "STRIKE")  # other kinds are skipped
    _write(root, "vehicle_positions", "2024-01-10", 5, "snapshot_20240110_050000.pb", m)
    _write(root, "vehicle_positions", "2024-01-10", 5, "snapshot_20240110_050100.pb",
           _feed(_epoch(2024, 1, 10, 10, 1)))  # empty feed: header only

    snaps = gtfs_rt.read_snapshots(spark, root, "vehicle_positions")
    rows = raw.raw_from_feed(snaps, "vehicle_positions").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.service_date, r.hour, r.entity_id, r.trip_id, r.trip_start_date) == (dt.date(2024, 1, 10), 5, "v1", "T1",
                                                                                   dt.date(2024, 1, 10))
    assert r.snapshot_timestamp == dt.datetime(2024, 1, 10, 5, 0)
    assert r.position_timestamp == dt.datetime(2024, 1, 10, 4, 59, 30)
    assert (r.current_status, r.occupancy_status, r.trip_schedule_rel) == ("STOPPED_AT", "FULL", "SCHEDULED")
    assert r.is_deleted is None and r.occupancy_percentage is None
    assert r.multi_carriage_details[0].occupancy_status == "EMPTY"
    assert abs(r.latitude - 42.25) < 1e-6


def test_alerts_from_files_dedupe_per_day(spark, tmpdir_path):
    root = tmpdir_path
    for minute, cause in ((0, "STRIKE"), (5, "WEATHER")):
        m = _feed(_epoch(2024, 1, 10, 15, minute))
        a = m.entity.add(id="A1").alert
        a.cause = enum_number("Cause", cause)
        a.severity_level = enum_number("SeverityLevel", "SEVERE")
        p = a.active_period.add(start=_epoch(2024, 1, 10, 0, 0))
        p2 = a.active_period.add(start=_epoch(2024, 1, 11, 0, 0), end=_epoch(2024, 1, 11, 1, 0))
        assert p and p2
        ie = a.informed_entity.add(route_id="R1", stop_id="P1", route_type=3)
        ie.trip.trip_id = "T9"
        a.header_text.translation.add(text=f"hdr {cause}", language="en")
        _write(root, "alerts", "2024-01-10", 10, f"snapshot_20240110_10{minute:02d}00.pb", m)
    rows = raw.raw_from_feed(gtfs_rt.read_snapshots(spark, root, "alerts"), "alerts").collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.cause == "WEATHER" and r.severity_level == "SEVERE"
    assert [(p.start is not None, p.end is not None) for p in r.active_period] == [(True, False), (True, True)]
    assert r.informed_entity[0].trip.trip_id == "T9"
    assert r.header_text.translation[0].text == "hdr WEATHER"


def test_trip_updates_from_files_stride_and_dedupe(spark, tmpdir_path):
    root = tmpdir_path
    for i in range(7):  # 7 files in one hour; stride 5 keeps files 0 and 5
        m = _feed(_epoch(2024, 1, 10, 15, i))
        t = m.entity.add(id=f"e{i}").trip_update
        t.trip.trip_id, t.trip.start_date = "T1", "20240110"
        t.trip.schedule_relationship = enum_number("ScheduleRelationship", "CANCELED" if i == 6 else "SCHEDULED")
        t.delay = i
        u = t.stop_time_update.add(stop_sequence=1, stop_id="P1")
        u.arrival.delay = 30
        _write(root, "trip_updates", "2024-01-10", 10, f"snapshot_20240110_10{i:02d}00.pb", m)
    snaps = gtfs_rt.read_snapshots(spark, root, "trip_updates")
    rows = raw.raw_from_feed(snaps, "trip_updates", stride=5).collect()
    assert [(r.delay, r.trip_schedule_rel) for r in rows] == [(5, "SCHEDULED")]  # file 6 (CANCELED) skipped
    assert rows[0].stop_time_update[0].arrival.delay == 30
    exact = raw.raw_from_feed(snaps, "trip_updates", stride=1).collect()
    assert [(r.delay, r.trip_schedule_rel) for r in exact] == [(6, "CANCELED")]
    # the data source opens the kept files only
    kept = gtfs_rt.landed(spark, root, "trip_updates", stride=5)
    assert kept.select("path").distinct().count() == 2
    _write(root, "trip_updates", "2024-01-10", 10, "snapshot_20240110_100300.pb", _Broken())       # not a message: never opened
    same = raw.raw_from_landed(spark, root, "trip_updates").collect()
    assert [(r.delay, r.trip_schedule_rel) for r in same] == [(5, "SCHEDULED")]


def test_day_filter_prunes_partitions(spark, tmpdir_path):
    root = tmpdir_path
    for day in ("2024-01-10", "2024-01-11"):
        m = _feed(_epoch(2024, 1, 10, 15, 0))
        m.entity.add(id=f"v{day}").vehicle.trip.trip_id = "T"
        _write(root, "vehicle_positions", day, 10, "snapshot_x.pb", m)
    snaps = gtfs_rt.read_snapshots(spark, root, "vehicle_positions", days=["2024-01-11"])
    plan = snaps._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "dt" in plan
    assert [r.entity_id for r in raw.raw_from_feed(snaps, "vehicle_positions").collect()] == ["v2024-01-11"]


def _positions(spark, n):
    rows = [(dt.datetime(2024, 1, 10, 5, 0, 0), f"v{i}", "T1", dt.date(2024, 1, 10), dt.datetime(2024, 1, 10, 4, 59))
            for i in range(n)]
    return spark.createDataFrame(rows, "snapshot_timestamp timestamp_ntz, entity_id string, trip_id string, "
                                       "trip_start_date date, position_timestamp timestamp_ntz")


def test_landing_splits_oversized_polls(spark, tmpdir_path):
    """A poll larger than the per-message cap becomes several part files; nothing is lost."""
    gtfs_rt.land(_positions(spark, 25), tmpdir_path, "vehicle_positions", max_entities=10, parts_per_snapshot=2)
    landed = gtfs_rt.landed(spark, tmpdir_path, "vehicle_positions")
    assert landed.select("path").distinct().count() >= 3
    back = raw.raw_from_landed(spark, tmpdir_path, "vehicle_positions")
    assert sorted(r.entity_id for r in back.collect()) == sorted(f"v{i}" for i in range(25))
    assert {r.snapshot_timestamp for r in back.collect()} == {dt.datetime(2024, 1, 10, 5, 0)}
    other = raw.raw_from_feed(gtfs_rt.read_snapshots(spark, tmpdir_path, "vehicle_positions"), "vehicle_positions")
    key = lambda df: sorted(map(str, df.drop("ingested_at").collect()))
    assert key(other) == key(back)                                      # binaryFile and the data source decode alike


def test_failed_landing_leaves_no_files(spark, tmpdir_path):
    """Tasks that had written their files before another one failed: the abort deletes what they wrote."""
    import pytest
    from pyspark.sql import functions as F

    rows = _positions(spark, 40).withColumn("snapshot_timestamp", F.expr(
        "timestampadd(SECOND, int(substr(entity_id, 2)), snapshot_timestamp)"))
    bad = rows.withColumn("current_stop_sequence", F.when(F.col("entity_id") == "v17", -1).otherwise(3))   # no uint32
    with pytest.raises(Exception):  # noqa: B017
        gtfs_rt.land(bad, tmpdir_path, "vehicle_positions")
    assert gtfs_rt.landed(spark, tmpdir_path, "vehicle_positions").count() == 0
    assert not [f for _, _, names in os.walk(tmpdir_path) for f in names if ".pb" in f and not f.endswith(".crc")]
    gtfs_rt.land(rows, tmpdir_path, "vehicle_positions")
    assert gtfs_rt.landed(spark, tmpdir_path, "vehicle_positions").count() == 40
    marks = [os.path.join(d, f) for d, _, names in os.walk(f"{tmpdir_path}/_landing") for f in names if f == "_COMMITTED"]
    assert [open(m).read() for m in marks] == ["40"]


def test_days_are_planned_from_their_folders(spark, tmpdir_path):
    from headway.sources.landing import LandingReader

    for day, hour in (("2024-01-10", 1), ("2024-01-10", 2), ("2024-01-11", 1)):
        m = _feed(_epoch(2024, 1, 10, 15, 0))
        m.entity.add(id=f"a{day}{hour}").alert.cause = enum_number("Cause", "STRIKE")
        _write(tmpdir_path, "alerts", day, hour, "snapshot_x.pb", m)
    plan = lambda **o: [p.path[-18:] for p in LandingReader({"path": tmpdir_path, "feed": "alerts", **o}, None).partitions()]
    assert len(plan()) == 3 and plan()[0].endswith("2024-01-10/hour=01")
    assert len(plan(days="2024-01-11,2024-03-01")) == 1 and len(plan(days="2023-01-01")) == 1
    assert gtfs_rt.landed(spark, tmpdir_path, "alerts", ["2023-01-01"]).count() == 0
    assert gtfs_rt.landed(spark, tmpdir_path, "alerts", ["2024-01-10"]).count() == 2


def test_every_field_survives_encoding_and_decoding():
    """All kinds, all nested fields, present and absent: columns -> messages -> columns."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructType

    from headway.sources import gtfs_rt_columns as C
    from headway.sources.gtfs_rt_proto import ENUMS

    enums = {"trip_schedule_rel": "ScheduleRelationship", "occupancy_status": "OccupancyStatus", "current_status": "VehicleStopStatus", "congestion_level": "CongestionLevel",
             "cause": "Cause", "effect": "Effect", "severity_level": "SeverityLevel", "wheelchair_accessible": "WheelchairAccessible"}

    def value(t, name, i):
        if isinstance(t, StructType):
            return {f.name: value(f.dataType, f.name, i + k) for k, f in enumerate(t.fields)}
        if isinstance(t, ArrayType):
            return [value(t.elementType, name, i + k) for k in range(i % 3)]
        if name == "schedule_relationship":                 # of trips and of stop times: the name that both enums have
            return "SCHEDULED"
        if name in enums:
            return ENUMS[enums[name]][i % 3][0]
        return {StringType: f"{name}{i}", LongType: 1000 + i, IntegerType: i, DoubleType: float(i), BooleanType: i % 2 == 0}[type(t)]

    for feed, kind in gtfs_rt.KINDS.items():
        st = StructType.fromDDL(gtfs_rt.DECODED_DDL[kind])
        rows = [{f.name: value(f.dataType, f.name, i + k) for k, f in enumerate(st.fields)} for i in range(7)]
        empty = {f.name: [] if isinstance(f.dataType, ArrayType) else None for f in st.fields}
        rows.append(empty | {"entity_id": "none", "header_timestamp": 5})
        for i, r in enumerate(rows):
            r.update(path=f"p{i // 3}.pb", gtfs_realtime_version="2.0", header_timestamp=5 + i // 3)
        schema = to_arrow_schema(st)
        files = list(C.encode_rows(iter([pa.RecordBatch.from_pylist(rows, schema)]), feed, 2))
        assert [f for f, _ in files] == ["p0.pb", "p0-c1.pb", "p1.pb", "p1-c1.pb", "p2.pb"]
        back = pa.Table.from_batches(C.decode_files(iter(files), feed, schema), schema).to_pylist()
        for r, b in zip(rows, back):
            assert b | {"path": r["path"]} == r, (feed, r, b)
