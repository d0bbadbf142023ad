"""GTFS static loader: CSV edge cases, version discovery, missing files, slice replacement."""

from __future__ import annotations

import datetime as dt
import os

from headway.plans import static
from headway.schemas import schema
from headway.sinks import tables as sinks
from headway.sources import gtfs_static


def _w(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _version(root, name, start="20240115", routes=True):
    _w(f"{root}/{name}/feed_info.txt",
       "feed_publisher_name,feed_publisher_url,feed_lang,feed_start_date,feed_end_date,feed_version\n"
       f'"Agency, Inc.",http://x,en,{start},20240401,"v ""1"""\n')
    if routes:
        _w(f"{root}/{name}/routes.txt",
           "route_id,route_short_name,route_long_name,route_type,route_sort_order\n"
           'R1,1,"Main, St",3,10\nR2,,"",3,x\n')
    _w(f"{root}/{name}/stop_times.txt",
       "trip_id,arrival_time,departure_time,stop_id,stop_sequence\nT1,25:10:30,25:10:30,P1,1\nT1,,,P2,2\n")
    _w(f"{root}/{name}/calendar.txt",
       "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\n"
       "S1,1,1,1,1,1,0,0,20240101,20241231\n")


def test_csv_quoting_and_types(spark, tmpdir_path):
    root = tmpdir_path
    _version(root, "v_20240115_080000")
    dims = static.build_dims(spark, f"{root}/v_20240115_080000")
    info = dims["dim_static_versions"].collect()[0]
    assert info.feed_publisher_name == "Agency, Inc." and info.feed_version == 'v "1"'
    assert info.feed_start_date == dt.date(2024, 1, 15) and info.collection_date == dt.date(2024, 1, 15)
    routes = {r.route_id: r for r in dims["dim_routes"].collect()}
    assert routes["R1"].route_long_name == "Main, St" and routes["R1"].route_sort_order == 10
    assert routes["R2"].route_short_name is None and routes["R2"].route_long_name is None
    assert routes["R2"].route_sort_order is None  # 'x' is not a number: NULL, not an error
    assert {r.feed_start_date for r in dims["dim_routes"].collect()} == {dt.date(2024, 1, 15)}
    st = sorted(dims["dim_stop_times"].collect(), key=lambda r: r.stop_sequence)
    assert [(r.arrival_seconds, r.departure_seconds) for r in st] == [(90630, 90630), (None, None)]
    cal = dims["dim_calendar"].collect()[0]
    assert cal.monday is True and cal.saturday is False and cal.end_date == dt.date(2024, 12, 31)
    assert dims["dim_agency"].count() == 0  # absent optional file -> empty typed table
    assert dims["dim_agency"].schema == schema("dim_agency")


def test_version_discovery(spark, tmpdir_path):
    root = tmpdir_path
    for name in ("v_20240110_060000", "v_20240115_080000", "v_20240115_200000", "v_bad", "notes"):
        _w(f"{root}/{name}/feed_info.txt", "feed_start_date\n20240101\n")
    assert gtfs_static.latest_version_dir(spark, root).endswith("v_20240115_200000")
    assert gtfs_static.version_dir_for_date(spark, root, "20240115").endswith("v_20240115_200000")
    assert gtfs_static.version_dir_for_date(spark, root, "20240110").endswith("v_20240110_060000")
    assert gtfs_static.version_dir_for_date(spark, root, "20240111") is None
    assert gtfs_static.latest_version_dir(spark, root + "/missing") is None


def test_load_replaces_only_its_version(spark, tmpdir_path):
    root, wh = tmpdir_path + "/gtfs", tmpdir_path + "/wh"
    _version(root, "v_20240110_060000", start="20240110")
    _version(root, "v_20240115_080000", start="20240115")
    for name in ("v_20240110_060000", "v_20240115_080000", "v_20240115_080000"):  # re-load is idempotent
        paths = static.load_static_version(spark, f"{root}/{name}", wh)
    routes = sinks.read_table(spark, paths["dim_routes"], schema("dim_routes"))
    counts = {r.feed_start_date: r[1] for r in routes.groupBy("feed_start_date").count().collect()}
    assert counts == {dt.date(2024, 1, 10): 2, dt.date(2024, 1, 15): 2}


def test_multi_line_file_in_splits_equals_the_whole_read(spark, tmpdir_path):
    """Fields over several lines, quotes, blank lines; cut into many splits, each read by a task of its own."""
    import random

    rng = random.Random(2)
    words = ["a", "b c", 'say ""hi""', "line\nbreak", "x,y", "\n\n", "", "end\r\nof", '""', "ö" * 5]
    rows = []
    for i in range(900):
        fields = [f'"{rng.choice(words)}{i}"' if rng.random() < 0.5 else str(rng.randint(0, 99)) for _ in range(3)]
        rows.append(",".join([f"T{i}", *fields]) + ("\n" if rng.random() < 0.05 else ""))
    long_ = '"' + "\n".join(f"row {i}, still the same field" for i in range(400)) + '"'
    rows.insert(450, f"LONG,{long_},,1")
    _w(f"{tmpdir_path}/v/stop_times.txt", "trip_id,a,b,c\n" + "\n".join(rows) + "\n")
    path = f"{tmpdir_path}/v/stop_times.txt"
    want = (spark.read.option("header", "true").option("quote", '"').option("escape", '"').option("multiLine", "true").csv(path))
    key = lambda df: sorted(map(str, df.collect()))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = gtfs_static.read_gtfs_csv(spark, path)
        assert gtfs_static._lines(spark, path).select("block").distinct().count() > 8
        assert got.columns == want.columns and key(got) == key(want)
        assert got.where("trip_id = 'LONG'").first().a.count("\n") == 399
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert key(gtfs_static.read_gtfs_csv(spark, path)) == key(want)
