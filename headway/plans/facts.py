"""RAW -> FACT builders.  Each takes the raw frame, the schedule versions and an optional date
set (None = every date present) and returns the fact rows for those dates in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions import (
    epoch_to_utc_ntz,
    first_translation_text,
    hours_by_minute_boundaries,
    in_late_window,
    in_overnight_window,
    not_deleted,
)
from headway.operators import asof_version, collapse_slices, latest_per_key, upsert_latest
from headway.plans._common import DateSet, in_dates, where_opt


def fact_vehicle_positions(raw_vp: DataFrame, versions: DataFrame, dates: DateSet = None) -> DataFrame:
    """Positions of trips starting on the requested days, with their overnight continuation
    (next day, hours 0-5), deleted entities removed, stamped with the schedule version in force on
    the trip start date."""
    df = where_opt(raw_vp, in_dates("service_date", dates, (0, 1)))  # partition pruning
    df = where_opt(df, in_dates("trip_start_date", dates))
    df = df.where(not_deleted("is_deleted")
                  & in_overnight_window("service_date", "hour", "trip_start_date"))
    return asof_version(df, "trip_start_date", versions)


def fact_trip_updates(raw_tu: DataFrame, versions: DataFrame, dates: DateSet = None) -> DataFrame:
    """Terminal state of each trip instance: newest snapshot collected on the trip day or the day
    after, ties by ingestion time then entity id (all descending, NULL first as in the source
    warehouse); the nested stop_time_update is dropped."""
    df = where_opt(raw_tu, in_dates("service_date", dates, (0, 1)))
    df = where_opt(df, in_dates("trip_start_date", dates))
    df = df.where(in_late_window("service_date", "trip_start_date")
                  & F.col("trip_id").isNotNull() & not_deleted("is_deleted"))
    df = latest_per_key(df, ["trip_start_date", "trip_id"], "snapshot_timestamp", nulls_first=True,
                        tiebreak=[F.col("ingested_at").desc_nulls_first(), F.col("entity_id").desc_nulls_first()])
    if "stop_time_update" in df.columns:
        df = df.drop("stop_time_update")
    return asof_version(df, "trip_start_date", versions)


# --- alerts: latest-state facts maintained by guarded upsert --------------------------------

_ALERT_TEXTS = ("effect_detail", "cause_detail", "header_text", "description_text", "url")


def _alert_source(raw_alerts: DataFrame, dates: DateSet) -> DataFrame:
    df = where_opt(raw_alerts, in_dates("service_date", dates))
    return df.where(not_deleted("is_deleted"))


def fact_alerts(raw_alerts: DataFrame, versions: DataFrame, dates: DateSet = None,
                target: DataFrame | None = None) -> DataFrame:
    """Latest known state per alert entity after applying the requested days to ``target``.

    Each day's rows are stamped with the version in force on that day; across days the newest
    snapshot wins and an equal snapshot never replaces an earlier one (strict guard)."""
    src = _alert_source(raw_alerts, dates)
    src = src.select(
        "entity_id", "snapshot_timestamp", "service_date",
        *[first_translation_text(F.col(c)).alias(c) for c in _ALERT_TEXTS],
        "cause", "effect", "severity_level", "gtfs_realtime_version", "ingested_at")
    src = asof_version(src, "service_date", versions)
    src = collapse_slices(src, ["entity_id"], "snapshot_timestamp", "service_date").drop("service_date")
    cols = ["entity_id", "snapshot_timestamp", "cause", "effect", "severity_level", *_ALERT_TEXTS,
            "gtfs_realtime_version", "ingested_at", "static_version_date"]
    return upsert_latest(target, src.select(*cols), ["entity_id"])


def fact_alerts_routes(raw_alerts: DataFrame, dates: DateSet = None,
                       target: DataFrame | None = None) -> DataFrame:
    """Latest known informed-entity mapping per (alert, route, stop); elements without a route or
    a stop are dropped; mappings are never deleted."""
    src = _alert_source(raw_alerts, dates)
    ie = src.select("entity_id", "snapshot_timestamp", "service_date",
                    F.explode("informed_entity").alias("ie"))
    ie = ie.select("entity_id", "snapshot_timestamp", "service_date",
                   F.col("ie.route_id").cast("string").alias("route_id"),
                   F.col("ie.stop_id").cast("string").alias("stop_id"),
                   F.col("ie.route_type").cast("int").alias("route_type"),
                   F.col("ie.direction_id").cast("int").alias("direction_id"),
                   F.col("ie.agency_id").cast("string").alias("agency_id"))
    ie = ie.where(F.col("route_id").isNotNull() & F.col("stop_id").isNotNull())
    keys = ["entity_id", "route_id", "stop_id"]
    ie = collapse_slices(ie, keys, "snapshot_timestamp", "service_date",
                         tiebreak=[F.col(c).asc_nulls_last() for c in ("route_type", "direction_id", "agency_id")])
    cols = ["entity_id", "snapshot_timestamp", "route_id", "stop_id", "route_type", "direction_id", "agency_id"]
    return upsert_latest(target, ie.select(*cols), keys)


def fact_alerts_active_periods(raw_alerts: DataFrame, dates: DateSet = None,
                               target: DataFrame | None = None) -> DataFrame:
    """Latest known active periods per (alert, period index).  Start/end are epoch seconds read as
    UTC wall clock; duration counts minute boundaries; periods without a start are dropped (the
    target declares it NOT NULL; the quality report counts them)."""
    src = _alert_source(raw_alerts, dates).where(F.size("active_period") > 0)
    ap = src.select("entity_id", "snapshot_timestamp", "service_date",
                    F.posexplode_outer("active_period").alias("period_index", "p"))
    start = epoch_to_utc_ntz(F.col("p.start"))
    end = epoch_to_utc_ntz(F.col("p.end"))
    ap = ap.select(
        "entity_id", "snapshot_timestamp", "service_date",
        F.col("period_index").cast("int").alias("period_index"),
        start.alias("active_start"), end.alias("active_end"),
        F.when(F.col("p.end").isNotNull(), hours_by_minute_boundaries(start, end)).alias("duration_hours"),
        F.col("p.end").isNull().alias("is_open_ended"),
    ).where(F.col("active_start").isNotNull())
    keys = ["entity_id", "period_index"]
    ap = collapse_slices(ap, keys, "snapshot_timestamp", "service_date")
    cols = ["entity_id", "snapshot_timestamp", "period_index", "active_start", "active_end",
            "duration_hours", "is_open_ended"]
    return upsert_latest(target, ap.select(*cols), keys)
