"""Quality checks and schema conformance on literal fixtures."""

from __future__ import annotations

import datetime as dt

import pytest

from headway.plans import quality
from headway.schemas import conform, schema

D = dt.date(2024, 1, 1)


def test_quality_counts_known_violations(spark):
    routes = spark.createDataFrame([(D, "R1"), (D, "R1"), (D, None)], "feed_start_date date, route_id string")
    trips = spark.createDataFrame([(D, "T1", "R1"), (D, "T2", "R7"), (D, "T3", None)],
                                  "feed_start_date date, trip_id string, route_id string")
    out = {(r.table_name, r.check_name): r.violations
           for r in quality.quality_report({"dim_routes": routes, "dim_trips": trips}).collect()}
    assert out[("dim_routes", "duplicate_key")] == 1  # R1 twice
    assert out[("dim_routes", "null_key")] == 1
    assert out[("dim_trips", "duplicate_key")] == 0 and out[("dim_trips", "null_key")] == 0
    assert out[("dim_trips", "orphan_feed_start_date_route_id")] == 1  # R7 has no route; NULL is not checked


def test_conform_fills_and_rejects(spark):
    df = spark.createDataFrame([(D, "R1", "3")], "feed_start_date date, route_id string, route_type string")
    out = conform(df, "dim_routes")
    assert out.schema == schema("dim_routes")
    r = out.collect()[0]
    assert r.route_type == 3 and r.route_short_name is None
    with pytest.raises(ValueError):
        conform(df.withColumnRenamed("route_type", "unexpected"), "dim_routes")
