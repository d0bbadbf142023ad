"""State changes under failures, day pruning, single evaluation of writes, polls in parts."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.plans import marts, raw
from headway.plans.model import TransitModel
from headway.session import scratch_path
from headway.sinks import tables as sinks
from headway.sources import gtfs_rt

SMALL = "/root/testdata/sf0.001"


def _alerts(spark, rows):
    return spark.createDataFrame(rows, "entity_id string, snapshot_timestamp timestamp, v int")


def _state(spark, path):
    return {r.entity_id: r.v for r in sinks.read_current(spark, path).collect()}


def _at(h):
    return dt.datetime(2024, 1, 10, h)


def _sets(spark, path):
    return dict(sinks.current_manifest(spark, path).slices)


def _crash(m):
    m.setattr(sinks, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))


def test_upsert_survives_a_crash_before_the_commit(spark, tmpdir_path):
    path = f"{tmpdir_path}/facts"
    sinks.upsert_table(_alerts(spark, [("a", _at(1), 1), ("b", _at(1), 1)]), path, ["entity_id"])
    with pytest.MonkeyPatch.context() as m:
        _crash(m)
        with pytest.raises(OSError):
            sinks.upsert_table(_alerts(spark, [("a", _at(2), 2)]), path, ["entity_id"])
    assert _state(spark, path) == {"a": 1, "b": 1}
    sinks.upsert_table(_alerts(spark, [("c", _at(1), 3)]), path, ["entity_id"])
    assert _state(spark, path) == {"a": 1, "b": 1, "c": 3}


def test_damaged_newest_manifest_falls_back_and_history_is_never_lost(spark, tmpdir_path):
    path = f"{tmpdir_path}/facts"
    sinks.upsert_table(_alerts(spark, [("a", _at(1), 1)]), path, ["entity_id"], buckets=1)
    first = _sets(spark, path)["bucket=0"]
    sinks.upsert_table(_alerts(spark, [("b", _at(1), 2)]), path, ["entity_id"])
    second = _sets(spark, path)["bucket=0"]
    os.remove(f"{path}/set={second}/_SUCCESS")                         # an incomplete set is not current
    assert _sets(spark, path) == {"bucket=0": first} and _state(spark, path) == {"a": 1}
    sinks.upsert_table(_alerts(spark, [("c", _at(1), 3)]), path, ["entity_id"])      # goes on from the good one
    assert _state(spark, path) == {"a": 1, "c": 3}
    for folder in os.listdir(path):
        if folder.startswith("set="):
            os.path.exists(f"{path}/{folder}/_SUCCESS") and os.remove(f"{path}/{folder}/_SUCCESS")
    with pytest.raises(RuntimeError):                                  # rather than starting a new table
        sinks.upsert_table(_alerts(spark, [("d", _at(1), 3)]), path, ["entity_id"])


def test_of_two_writers_one_fails(spark, tmpdir_path):
    path = f"{tmpdir_path}/facts"
    sinks.upsert_table(_alerts(spark, [("a", _at(1), 1)]), path, ["entity_id"])
    write = sinks._write_set
    with pytest.MonkeyPatch.context() as m:
        def late(*args):                                              # another writer commits while this one writes
            m.setattr(sinks, "_write_set", write)
            sinks.upsert_table(_alerts(spark, [("a", _at(3), 3)]), path, ["entity_id"])
            return write(*args)

        m.setattr(sinks, "_write_set", late)
        with pytest.raises(RuntimeError):
            sinks.upsert_table(_alerts(spark, [("a", _at(2), 2)]), path, ["entity_id"])
    assert _state(spark, path) == {"a": 3}


def test_readers_keep_their_files_and_old_ones_go_by_age(spark, tmpdir_path):
    path = f"{tmpdir_path}/facts"
    sinks.upsert_table(_alerts(spark, [("a", _at(1), 1), ("b", _at(1), 1)]), path, ["entity_id"])
    reader = sinks.read_current(spark, path)
    for h in range(2, 6):
        sinks.upsert_table(_alerts(spark, [("a", _at(h), h)]), path, ["entity_id"])
    assert {r.entity_id: r.v for r in reader.collect()} == {"a": 1, "b": 1} and _state(spark, path) == {"a": 5, "b": 1}
    assert sinks.remove_old_files(spark, path) == 0
    assert sinks.remove_old_files(spark, path, older_than_hours=-1) == 4 and _state(spark, path) == {"a": 5, "b": 1}
    sinks.upsert_table(_alerts(spark, [("b", _at(9), 9)]), path, ["entity_id"])
    assert _state(spark, path) == {"a": 5, "b": 9}


def test_upsert_leaves_untouched_buckets_alone(spark, tmpdir_path):
    """Only buckets with a changed row get new files; rows that change nothing write nothing."""
    path = f"{tmpdir_path}/facts"
    sinks.upsert_table(_alerts(spark, [(f"e{i}", _at(2), i) for i in range(200)]), path, ["entity_id"], buckets=16)
    before = _sets(spark, path)
    assert len(before) == 16
    files = set(sinks.read_current(spark, path).inputFiles())
    assert sinks.upsert_table(_alerts(spark, [("e3", _at(3), -3), ("e5", _at(2), -5), ("e6", _at(1), -6), ("e7", None, -7)]),
                              path, ["entity_id"]) == 1
    after = _sets(spark, path)
    assert sum(before[k] != after[k] for k in before) == 1
    assert len(files & set(sinks.read_current(spark, path).inputFiles())) == len(files) - 1
    assert _state(spark, path) == {**{f"e{i}": i for i in range(200)}, "e3": -3}
    assert sinks.upsert_table(_alerts(spark, [("e3", _at(3), 0)]), path, ["entity_id"]) == 0       # a replay
    assert _sets(spark, path) == after


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rounds=st.lists(st.dictionaries(st.sampled_from("abcdef"), st.one_of(st.none(), st.integers(0, 4)), min_size=1), min_size=1,
                       max_size=4), buckets=st.sampled_from([1, 3]))
def test_bucketed_upserts_equal_the_plain_upsert(spark, rounds, buckets):
    from headway.operators import upsert_latest

    path, target = scratch_path(spark, "upserts"), None
    for i, one in enumerate(rounds):
        src = _alerts(spark, [(k, None if h is None else _at(h), i) for k, h in one.items()])
        sinks.upsert_table(src, path, ["entity_id"], buckets=buckets)
        rows = upsert_latest(target, src, ["entity_id"]).collect()
        target = spark.createDataFrame(rows, src.schema)
    assert sorted(map(tuple, sinks.read_current(spark, path).collect()), key=str) == sorted(map(tuple, target.collect()), key=str)


def test_many_slices_change_by_one_switch(spark, tmpdir_path):
    """A job killed before its commit leaves all days old; after the commit all are new, in one file per day."""
    path = f"{tmpdir_path}/t"
    old = spark.range(2400).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("day"),
                                   (F.col("id") % 24).cast("int").alias("hour"), F.lit("old").alias("v"))
    sinks.write_table(old, path, ["day"], ["hour"])
    new = old.where("day < '2024-01-04'").withColumn("v", F.lit("new"))
    days = [{"day": f"2024-01-0{i}"} for i in (1, 2, 3)]
    read = lambda: {(str(r.day), r.v): r["count"] for r in sinks.read_table(spark, path).groupBy("day", "v").count().collect()}
    before = read()
    with pytest.MonkeyPatch.context() as m:
        _crash(m)
        with pytest.raises(OSError):
            sinks.replace_slices(new, path, ["day"], days, ["hour"])
    assert read() == before == {(f"2024-01-0{i}", "old"): 480 for i in range(1, 6)}
    sinks.replace_slices(new, path, ["day"], days, ["hour"])
    assert read() == {(f"2024-01-0{i}", "new" if i < 4 else "old"): 480 for i in range(1, 6)}
    assert len(sinks.read_table(spark, path).inputFiles()) <= 8
    # some hours of a day: its other hours are carried over, hours without new rows go
    part = old.where("day = '2024-01-02' and hour = 7").limit(3).withColumn("v", F.lit("h7"))
    sinks.replace_slices(part, path, ["day"], [{"day": "2024-01-02", "hour": 7}, {"day": "2024-01-02", "hour": 8}], ["hour"])
    rows = {(r.hour, r.v): r["count"] for r in sinks.read_table(spark, path).where("day = '2024-01-02'").groupBy("hour", "v").count().collect()}
    assert rows == {**{(h, "new"): 20 for h in range(24) if h not in (7, 8)}, (7, "h7"): 3}
    assert read()["2024-01-03", "new"] == 480


def test_failed_replace_leaves_the_old_slice(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    old = spark.createDataFrame([("2024-01-01", 1, "x"), ("2024-01-01", 2, "y"), ("2024-01-02", 1, "z")],
                                "day string, hour int, v string").withColumn("day", F.col("day").cast("date"))
    sinks.write_table(old, path, ["day", "hour"])
    boom = F.udf(lambda v: 1 / 0, "string")
    with pytest.raises(Exception):  # noqa: B017
        sinks.replace_slices(old.where("day = '2024-01-01'").withColumn("v", boom("v")), path, ["day", "hour"],
                             [{"day": "2024-01-01"}])
    read = lambda: sorted((str(r.day), r.hour, r.v) for r in sinks.read_table(spark, path).collect())
    assert read() == [("2024-01-01", 1, "x"), ("2024-01-01", 2, "y"), ("2024-01-02", 1, "z")]
    new = old.where("day = '2024-01-01' and hour = 1").withColumn("v", F.lit("new"))
    sinks.replace_slices(new, path, ["day", "hour"], [{"day": "2024-01-01"}])
    assert read() == [("2024-01-01", 1, "new"), ("2024-01-02", 1, "z")]      # hour 2 lost its rows
    sinks.write_table(new, path, ["day", "hour"])                            # whole table, whatever the session says
    assert read() == [("2024-01-01", 1, "new")]


def test_a_write_evaluates_its_plan_once(spark, tmpdir_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).select((F.col("id") % 3).alias("day"), "id").mapInArrow(count, "day long, id long")
    sinks.write_table(df, f"{tmpdir_path}/once", ["day"], ["id"])
    assert seen.value == 1000 and spark.read.parquet(f"{tmpdir_path}/once").count() == 1000


def test_daily_marts_read_only_their_days(spark, tmpdir_path):
    m = TransitModel(spark, SMALL)
    days = ["2024-01-10"]
    for name, frame in (("vp", m.fact_vehicle_positions), ("tu", m.fact_trip_updates)):
        sinks.write_table(frame, f"{tmpdir_path}/{name}", ["trip_start_date"])
    vp, tu = (sinks.read_table(spark, f"{tmpdir_path}/{n}") for n in ("vp", "tu"))
    occ = marts.mart_occupancy_route_hour(vp, m.t.dim_routes, days)
    svc = marts.mart_service_delivered(m.scheduled_bus_trips, tu, days)
    for df, scans in ((occ, 1), (svc, 1)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        hits = [line for line in plan.splitlines() if "PartitionFilters: [" in line and "trip_start_date" in line
                and ("2024-01-10" in line or "19732" in line)]
        assert len(hits) >= scans, plan
    want = {r.hour: r.snapshot_count for r in marts.mart_occupancy_route_hour(m.fact_vehicle_positions, m.t.dim_routes, days).groupBy(
        "hour").agg(F.sum("snapshot_count").alias("snapshot_count")).collect()}
    assert want == {r.hour: r.snapshot_count for r in occ.groupBy("hour").agg(F.sum("snapshot_count").alias("snapshot_count")).collect()}


def test_day_load_lists_only_its_day(spark, tmpdir_path):
    for day in ("2024-01-10", "2024-01-11"):
        folder = f"{tmpdir_path}/rt/alerts/dt={day}/hour=01"
        os.makedirs(folder)
        with open(f"{folder}/snapshot_x.pb", "wb") as f:
            f.write(b"")
    df = gtfs_rt.read_snapshots(spark, f"{tmpdir_path}/rt", "alerts", ["2024-01-10", "2024-02-01"])
    files = list(df.inputFiles())
    assert len(files) == 1 and "dt=2024-01-10" in files[0].replace("%3D", "=")
    assert gtfs_rt.read_snapshots(spark, f"{tmpdir_path}/rt", "alerts", ["2023-01-01"]).count() == 0


def test_model_sees_a_changed_folder(spark, tmpdir_path):
    """A query after new events landed counts them: nothing is kept per session."""
    from headway.plans.registry import registry

    folder = f"{tmpdir_path}/data"
    for t in ("events", "supplier", "customer", "orders", "nation", "region"):
        df = spark.read.parquet(f"{SMALL}/{t}.parquet")
        (df.where("ts >= timestamp_ntz'2024-01-10 00:00:00'") if t == "events" else df).write.parquet(f"{folder}/{t}.parquet")
    q = registry()["active_services"]
    plan = q(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    before = q(spark, folder).count()
    assert "Relation" in plan
    spark.read.parquet(f"{SMALL}/events.parquet").where("ts < timestamp_ntz'2024-01-10 00:00:00'").write.mode("append").parquet(
        f"{folder}/events.parquet")
    assert q(spark, folder).count() > before


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(cap=st.integers(1, 8), parts=st.integers(1, 3))
def test_stride_counts_polls_whatever_the_parts(spark, cap, parts):
    rows = [(dt.datetime(2024, 1, 10, 8, minute), f"e{minute}-{i}", f"T{i}", "R1", 0, dt.date(2024, 1, 10), "SCHEDULED", False)
            for minute in range(0, 20) for i in range(7)]
    tu = spark.createDataFrame(rows, "snapshot_timestamp timestamp_ntz, entity_id string, trip_id string, route_id string, "
                                     "direction_id int, trip_start_date date, trip_schedule_rel string, is_deleted boolean")
    root = scratch_path(spark, "landing")
    gtfs_rt.land(tu, root, "trip_updates", parts_per_snapshot=parts, max_entities=cap)
    got = {(r.trip_id, r.entity_id) for r in raw.raw_from_landed(spark, root, "trip_updates").collect()}
    assert got == {(f"T{i}", f"e15-{i}") for i in range(7)}


def test_replaced_hours_are_first_written_whole(spark, monkeypatch):
    """The hour key replaces slices of every day that hold all snapshot rows."""
    from headway.plans import registry

    d = "/root/testdata/sf0.001"
    met = []
    replace = registry.sinks.replace_slices

    def seen(df, path, *args):
        met.append([]) or met[-1].extend(tuple(r) for r in sinks.read_table(spark, path).groupBy("service_date", "hour").count().collect())
        return replace(df, path, *args)

    monkeypatch.setattr(registry.sinks, "replace_slices", seen)
    out = registry.registry()["sink_replace_hours"](spark, d)
    snapshots = registry._m(spark, d).t.raw_trip_updates
    want = sorted(tuple(r) for r in snapshots.groupBy("service_date", "hour").count().collect())
    assert sorted((str(a), int(h), n) for a, h, n in met[0] if int(h) != 99) == [(str(a), int(h), n) for a, h, n in want]
    assert len(met) == 2 and [n for _, h, n in met[1] if int(h) == 99] == [1]
    assert out.where("hour = 99").count() == 0


def test_thousands_of_hour_slices_are_replaced_by_one_switch(spark, tmpdir_path):
    """Slices that also name other columns: the carried rows are found by a join, not by a condition per slice."""
    path = f"{tmpdir_path}/t"
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 2).cast("int"))
    old = spark.range(8_004).select(day.alias("day"), F.when(F.col("id") < 8_000, F.col("id") / 2).cast("int").alias("hour"), F.lit("old").alias("v"))
    sinks.write_table(old, path, ["day"], ["hour"])
    new = old.where("day = '2024-01-01' and hour < 3000 and hour % 2 = 0").withColumn("v", F.lit("new"))
    sinks.replace_slices(new, path, ["day"], [{"day": "2024-01-01", "hour": h} for h in [*range(3_000), None]], ["hour"])
    rows = {(str(r.day), r.v): (r.n, r.least, r.missing) for r in sinks.read_table(spark, path).groupBy("day", "v").agg(
        F.count(F.lit(1)).alias("n"), F.min("hour").alias("least"), F.count_if(F.col("hour").isNull()).alias("missing")).collect()}
    assert rows == {("2024-01-01", "new"): (1_500, 0, 0), ("2024-01-01", "old"): (1_000, 3_000, 0), ("2024-01-02", "old"): (4_002, 0, 2)}
