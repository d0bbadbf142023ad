"""Table definitions: column types of every RAW / STATIC / FACT / MART table, their keys and
foreign keys, and schema conformance of a DataFrame to a table.

The column lists are fixed by the data contract and stated here as Spark DDL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# GTFS-realtime nested types (public specification field names).
TRANSLATED = "STRUCT<translation: ARRAY<STRUCT<text: STRING, language: STRING>>>"
TRIP_DESCRIPTOR = ("STRUCT<trip_id: STRING, route_id: STRING, direction_id: INT, start_time: STRING, "
                   "start_date: STRING, schedule_relationship: STRING>")
ACTIVE_PERIODS = "ARRAY<STRUCT<start: BIGINT, end: BIGINT>>"
INFORMED_ENTITIES = (f"ARRAY<STRUCT<agency_id: STRING, route_id: STRING, route_type: INT, trip: {TRIP_DESCRIPTOR}, "
                     "stop_id: STRING, direction_id: INT>>")
CARRIAGES = ("ARRAY<STRUCT<id: STRING, label: STRING, occupancy_status: STRING, occupancy_percentage: INT, "
             "carriage_sequence: INT>>")
STOP_TIME_EVENT = "STRUCT<delay: INT, time: BIGINT, uncertainty: INT>"
STOP_TIME_UPDATES = (f"ARRAY<STRUCT<stop_sequence: INT, stop_id: STRING, arrival: {STOP_TIME_EVENT}, "
                     f"departure: {STOP_TIME_EVENT}, schedule_relationship: STRING>>")
MODIFIED_TRIP = "STRUCT<modifications_id: STRING, affected_trip_id: STRING>"
TRIP_PROPERTIES = "STRUCT<trip_id: STRING, start_date: STRING, start_time: STRING, shape_id: STRING>"

_RT_HEAD = ("service_date DATE, hour INT, snapshot_timestamp TIMESTAMP_NTZ, ingested_at TIMESTAMP_NTZ, "
            "gtfs_realtime_version STRING, entity_id STRING, is_deleted BOOLEAN")

DDL: dict[str, str] = {
    "raw_vehicle_positions": (
        f"{_RT_HEAD}, trip_id STRING, route_id STRING, direction_id INT, trip_start_time STRING, "
        "trip_start_date DATE, trip_schedule_rel STRING, vehicle_id STRING, vehicle_label STRING, "
        f"multi_carriage_details {CARRIAGES}, latitude DOUBLE, longitude DOUBLE, bearing DOUBLE, odometer DOUBLE, "
        "speed DOUBLE, current_stop_sequence INT, stop_id STRING, current_status STRING, congestion_level STRING, "
        "occupancy_status STRING, occupancy_percentage INT, position_timestamp TIMESTAMP_NTZ"),
    "raw_alerts": (
        f"{_RT_HEAD}, cause STRING, effect STRING, severity_level STRING, active_period {ACTIVE_PERIODS}, "
        f"informed_entity {INFORMED_ENTITIES}, url {TRANSLATED}, header_text {TRANSLATED}, "
        f"description_text {TRANSLATED}, tts_header_text {TRANSLATED}, tts_description_text {TRANSLATED}, "
        f"cause_detail {TRANSLATED}, effect_detail {TRANSLATED}"),
    "raw_trip_updates": (
        f"{_RT_HEAD}, trip_id STRING, route_id STRING, direction_id INT, trip_start_time STRING, "
        f"trip_start_date DATE, trip_schedule_rel STRING, modified_trip {MODIFIED_TRIP}, vehicle_id STRING, "
        "vehicle_label STRING, vehicle_license_plate STRING, wheelchair_accessible STRING, "
        f"trip_update_timestamp TIMESTAMP_NTZ, delay INT, stop_time_update {STOP_TIME_UPDATES}, "
        f"trip_properties {TRIP_PROPERTIES}"),
    "dim_static_versions": (
        "feed_start_date DATE, feed_end_date DATE, feed_version STRING, feed_publisher_name STRING, "
        "feed_publisher_url STRING, feed_lang STRING, feed_contact_email STRING, feed_id STRING, "
        "collection_date DATE, collected_at TIMESTAMP, ingested_at TIMESTAMP"),
    "dim_agency": (
        "feed_start_date DATE, agency_id STRING, agency_name STRING, agency_url STRING, agency_timezone STRING, "
        "agency_lang STRING, agency_phone STRING, agency_fare_url STRING, ingested_at TIMESTAMP"),
    "dim_routes": (
        "feed_start_date DATE, route_id STRING, agency_id STRING, route_short_name STRING, route_long_name STRING, "
        "route_desc STRING, route_type INT, route_url STRING, route_color STRING, route_text_color STRING, "
        "route_sort_order INT, route_fare_class STRING, line_id STRING, listed_route STRING, network_id STRING, "
        "ingested_at TIMESTAMP"),
    "dim_stops": (
        "feed_start_date DATE, stop_id STRING, stop_code STRING, stop_name STRING, stop_desc STRING, "
        "platform_code STRING, platform_name STRING, stop_lat DOUBLE, stop_lon DOUBLE, zone_id STRING, "
        "stop_url STRING, level_id STRING, location_type INT, parent_station STRING, wheelchair_boarding INT, "
        "stop_address STRING, municipality STRING, on_street STRING, at_street STRING, vehicle_type INT, "
        "ingested_at TIMESTAMP"),
    "dim_trips": (
        "feed_start_date DATE, trip_id STRING, route_id STRING, service_id STRING, trip_headsign STRING, "
        "trip_short_name STRING, direction_id INT, block_id STRING, shape_id STRING, wheelchair_accessible INT, "
        "bikes_allowed INT, trip_route_type INT, route_pattern_id STRING, ingested_at TIMESTAMP"),
    "dim_stop_times": (
        "feed_start_date DATE, trip_id STRING, stop_sequence INT, stop_id STRING, arrival_time STRING, "
        "departure_time STRING, stop_headsign STRING, pickup_type INT, drop_off_type INT, timepoint INT, "
        "checkpoint_id STRING, continuous_pickup INT, continuous_drop_off INT, arrival_seconds INT, "
        "departure_seconds INT, ingested_at TIMESTAMP"),
    "dim_calendar": (
        "feed_start_date DATE, service_id STRING, monday BOOLEAN, tuesday BOOLEAN, wednesday BOOLEAN, "
        "thursday BOOLEAN, friday BOOLEAN, saturday BOOLEAN, sunday BOOLEAN, start_date DATE, end_date DATE, "
        "ingested_at TIMESTAMP"),
    "dim_calendar_dates": (
        "feed_start_date DATE, service_id STRING, date DATE, exception_type INT, holiday_name STRING, "
        "ingested_at TIMESTAMP"),
    "fact_alerts": (
        "entity_id STRING, snapshot_timestamp TIMESTAMP_NTZ, cause STRING, effect STRING, severity_level STRING, "
        "effect_detail STRING, cause_detail STRING, header_text STRING, description_text STRING, url STRING, "
        "gtfs_realtime_version STRING, ingested_at TIMESTAMP_NTZ, static_version_date DATE"),
    "fact_alerts_routes": (
        "entity_id STRING, snapshot_timestamp TIMESTAMP_NTZ, route_id STRING, stop_id STRING, route_type INT, "
        "direction_id INT, agency_id STRING"),
    "fact_alerts_active_periods": (
        "entity_id STRING, snapshot_timestamp TIMESTAMP_NTZ, period_index INT, active_start TIMESTAMP_NTZ, "
        "active_end TIMESTAMP_NTZ, duration_hours DOUBLE, is_open_ended BOOLEAN"),
    "metric_stop_events": (
        "service_date DATE, trip_start_date DATE, hour INT, trip_id STRING, route_id STRING, route_name STRING, "
        "route_type INT, direction_id INT, stop_id STRING, stop_sequence INT, actual_arrival_ts TIMESTAMP_NTZ, "
        "actual_arrival_seconds INT, scheduled_arrival_time STRING, scheduled_arrival_seconds INT, "
        "arrival_delay_seconds INT, is_on_time BOOLEAN, occupancy_status STRING, occupancy_percentage INT, "
        "static_version_date DATE"),
    "metric_occupancy_route_hour": (
        "service_date DATE, hour INT, route_id STRING, route_name STRING, snapshot_count BIGINT, "
        "avg_occupancy_pct DOUBLE, pct_snapshots_reporting DOUBLE, pct_empty DOUBLE, pct_many_seats DOUBLE, "
        "pct_few_seats DOUBLE, pct_standing_room DOUBLE, pct_crushed_standing DOUBLE, pct_full DOUBLE, "
        "pct_no_data_occupancy DOUBLE"),
    "metric_alerts_by_day": (
        "alert_date DATE, route_id STRING, route_name STRING, alert_count BIGINT, severe_count BIGINT, "
        "warning_count BIGINT, info_count BIGINT"),
    "metric_alerts_by_day_stops": (
        "alert_date DATE, stop_name STRING, stop_lat DOUBLE, stop_lon DOUBLE, alert_count BIGINT, "
        "severe_count BIGINT, warning_count BIGINT, info_count BIGINT"),
    "metric_service_delivered": (
        "service_date DATE, trip_start_date DATE, route_id STRING, route_name STRING, direction_id INT, "
        "scheduled_trips BIGINT, delivered_trips BIGINT, canceled_trips BIGINT, no_rt_data_trips BIGINT, "
        "added_trips BIGINT, pct_delivered DOUBLE, static_version_date DATE"),
}
DDL["fact_vehicle_positions"] = DDL["raw_vehicle_positions"] + ", static_version_date DATE"
DDL["fact_trip_updates"] = (DDL["raw_trip_updates"].replace(f", stop_time_update {STOP_TIME_UPDATES}", "")
                            + ", static_version_date DATE")

# Declared primary keys.
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "dim_static_versions": ("feed_start_date",),
    "dim_agency": ("feed_start_date", "agency_id"),
    "dim_routes": ("feed_start_date", "route_id"),
    "dim_stops": ("feed_start_date", "stop_id"),
    "dim_trips": ("feed_start_date", "trip_id"),
    "dim_stop_times": ("feed_start_date", "trip_id", "stop_sequence"),
    "dim_calendar": ("feed_start_date", "service_id"),
    "dim_calendar_dates": ("feed_start_date", "service_id", "date"),
    "fact_vehicle_positions": ("service_date", "entity_id", "snapshot_timestamp"),
    "fact_trip_updates": ("trip_start_date", "trip_id"),
    "fact_alerts": ("entity_id",),
    "fact_alerts_routes": ("entity_id", "route_id", "stop_id"),
    "fact_alerts_active_periods": ("entity_id", "period_index"),
    "metric_stop_events": ("service_date", "trip_id", "stop_sequence"),
    "metric_occupancy_route_hour": ("service_date", "hour", "route_id"),
    "metric_alerts_by_day": ("alert_date", "route_id"),
    "metric_alerts_by_day_stops": ("alert_date", "stop_name"),
    "metric_service_delivered": ("trip_start_date", "route_id", "direction_id"),
}

# Foreign keys (child table, child columns, parent table, parent columns).  Every schedule
# table refers to its version; the last three are the keys that joins between schedule tables rely on.
FOREIGN_KEYS: tuple[tuple[str, tuple[str, ...], str, tuple[str, ...]], ...] = (
    *((t, ("feed_start_date",), "dim_static_versions", ("feed_start_date",))
      for t in ("dim_agency", "dim_routes", "dim_stops", "dim_trips", "dim_stop_times", "dim_calendar",
                "dim_calendar_dates")),
    ("dim_trips", ("feed_start_date", "route_id"), "dim_routes", ("feed_start_date", "route_id")),
    ("dim_stop_times", ("feed_start_date", "trip_id"), "dim_trips", ("feed_start_date", "trip_id")),
    ("dim_stop_times", ("feed_start_date", "stop_id"), "dim_stops", ("feed_start_date", "stop_id")),
)

# Physical layout: partition column and clustering (sort) columns per written table.
LAYOUT: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "raw_vehicle_positions": (("service_date",), ("hour", "route_id", "trip_id")),
    "raw_alerts": (("service_date",), ("entity_id",)),
    "raw_trip_updates": (("service_date",), ("hour", "trip_id")),
    "fact_vehicle_positions": (("trip_start_date",), ("route_id", "trip_id")),
    "fact_trip_updates": (("trip_start_date",), ("trip_id",)),
    "metric_stop_events": (("trip_start_date",), ("route_id",)),
    "metric_occupancy_route_hour": (("service_date",), ("route_id",)),
    "metric_alerts_by_day": (("alert_date",), ("route_id",)),
    "metric_alerts_by_day_stops": (("alert_date",), ("stop_name",)),
    "metric_service_delivered": (("trip_start_date",), ("route_id",)),
    **{t: (("feed_start_date",), k[1:2]) for t, k in PRIMARY_KEYS.items() if t.startswith("dim_")},
}


def schema(table: str) -> StructType:
    return StructType.fromDDL(DDL[table])


def conform(df: DataFrame, table: str, allow_extra: bool = False) -> DataFrame:
    """Select ``df`` as ``table``: columns by name in table order, cast to the declared types;
    missing columns become typed NULLs; extra columns are an error unless ``allow_extra``."""
    st = schema(table)
    names = {f.name for f in st.fields}
    extra = [c for c in df.columns if c not in names]
    if extra and not allow_extra:
        raise ValueError(f"{table}: unexpected columns {extra}")
    cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in st.fields]
    return df.select(*cols)


def empty(spark, table: str) -> DataFrame:
    """An empty DataFrame typed as ``table`` (absent optional source file)."""
    return spark.createDataFrame([], schema(table))
