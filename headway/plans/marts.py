"""FACT -> MART builders (stop events, occupancy, alerts by day, service delivered).

Joins to schedule dimensions are equi-joins on (key, version).  Small dimensions (routes, stops,
calendar) are left to the planner's size-checked broadcast; the trip-level joins against
``stop_times`` (the largest dimension) are asked to shuffle on their keys - the planner's estimate of a
table made by exploding a smaller one is many times too low - and AQE splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions import (
    ADDED,
    BUS_ROUTE_TYPE,
    CANCELED,
    DELIVERED,
    GTFS_WEEKDAY_COLUMNS,
    NO_RT_DATA,
    delivery_status,
    hms_hour,
    is_on_time,
    ratio_pct,
    schedule_relationship,
    share_pct,
    seconds_since_day_start,
    weekday_flag,
)
from headway.operators import (
    OCCUPANCY_STATUS_COLUMNS,
    active_on_dates,
    clipped_days,
    daily_totals,
    earliest_per_key,
    resolve_dates,
    union_of_days,
)
from headway.plans._common import DateSet, col_or_null, date_frame, dealt, in_dates, where_opt

COORD_DECIMALS = 9  # averaged coordinates are rounded to 1e-9 degree (sub-millimetre)
COORD_SUM = "decimal(20,12)"


def _bus_routes(routes: DataFrame) -> DataFrame:
    return (routes.where(F.col("route_type") == BUS_ROUTE_TYPE)
                  .select("feed_start_date", "route_id", F.col("route_short_name").alias("route_name"),
                          "route_type"))


def mart_stop_events(fact_vp: DataFrame, stop_times: DataFrame, routes: DataFrame,
                     dates: DateSet = None) -> DataFrame:
    """First STOPPED_AT observation per stop visit, matched to its scheduled arrival; bus only,
    first stop excluded.  Delay = actual - scheduled wall-clock seconds from trip-day midnight."""
    s = where_opt(fact_vp, in_dates("trip_start_date", dates))
    s = s.where((F.col("current_status") == "STOPPED_AT") & (F.col("current_stop_sequence") != 1))
    s = earliest_per_key(s, ["trip_start_date", "trip_id", "current_stop_sequence"], "position_timestamp",
                         tiebreak=[F.col("entity_id").asc_nulls_last()])
    s = s.select(
        "service_date", "trip_start_date", "hour", "trip_id", "route_id",
        col_or_null(s, "direction_id", "int"), "stop_id",
        F.col("current_stop_sequence").alias("stop_sequence"),
        F.col("position_timestamp").alias("actual_arrival_ts"),
        seconds_since_day_start("trip_start_date", "position_timestamp").alias("actual_arrival_seconds"),
        "occupancy_status", "occupancy_percentage", "static_version_date")
    st = stop_times.select(F.col("feed_start_date").alias("static_version_date"), "trip_id", "stop_sequence",
                           F.col("arrival_time").alias("scheduled_arrival_time"),
                           F.col("arrival_seconds").alias("scheduled_arrival_seconds"))
    r = _bus_routes(routes).withColumnRenamed("feed_start_date", "static_version_date")
    j = (s.join(st.hint("merge"), ["trip_id", "stop_sequence", "static_version_date"])
          .join(r, ["route_id", "static_version_date"]))
    delay = (F.col("actual_arrival_seconds") - F.col("scheduled_arrival_seconds")).cast("int")
    return j.select(
        "service_date", "trip_start_date", "hour", "trip_id", "route_id", "route_name", "route_type",
        "direction_id", "stop_id", "stop_sequence", "actual_arrival_ts", "actual_arrival_seconds",
        "scheduled_arrival_time", "scheduled_arrival_seconds", delay.alias("arrival_delay_seconds"),
        is_on_time(delay).alias("is_on_time"), "occupancy_status", "occupancy_percentage",
        "static_version_date")


def mart_occupancy_route_hour(fact_vp: DataFrame, routes: DataFrame, dates: DateSet = None) -> DataFrame:
    """Occupancy per (service_date, hour, route) for buses, first stop excluded.

    Plan: the fact rows are first reduced to counts per (service_date, hour, route, version) in a
    numeric hash aggregate (partial per task, so a hot route is pre-combined before the shuffle);
    only those partial counts meet the route dimension (inner join = bus filter) and the final
    roll-up over versions.  Every output equals the row-level formula: shares are counts over the
    row count, the mean is sum / count of the reported percentages."""
    f = where_opt(fact_vp, in_dates("service_date", dates))
    # the fact is partitioned by trip day: a service day holds trips of that day and the day before
    f = where_opt(f, in_dates("trip_start_date", dates, shift_days=(0, -1)))
    f = f.where(F.col("current_stop_sequence") != 1)
    occ, status = F.col("occupancy_percentage"), F.col("occupancy_status")
    shares = list(OCCUPANCY_STATUS_COLUMNS.items())
    part = f.groupBy("service_date", "hour", "route_id", "static_version_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(occ).alias("n_occ"),
        F.sum(occ.cast("bigint")).alias("sum_occ"),
        *[F.count_if(status.isNull() if v is None else status == v).alias(f"n_{name}") for name, v in shares])
    r = _bus_routes(routes).select(F.col("feed_start_date").alias("static_version_date"), "route_id", "route_name")
    j = part.join(r, ["route_id", "static_version_date"])
    agg = j.groupBy("service_date", "hour", "route_id").agg(
        F.max("route_name").alias("route_name"),
        F.sum("n").alias("snapshot_count"),
        F.sum("n_occ").alias("n_occ"), F.sum("sum_occ").alias("sum_occ"),
        *[F.sum(f"n_{name}").alias(f"n_{name}") for name, _ in shares])
    return agg.select(
        "service_date", "hour", "route_id", "route_name", "snapshot_count",
        (F.col("sum_occ").cast("double") / F.nullif(F.col("n_occ"), F.lit(0)).cast("double")).alias("avg_occupancy_pct"),
        share_pct("n_occ", "snapshot_count").alias("pct_snapshots_reporting"),
        *[share_pct(f"n_{name}", "snapshot_count").alias(name) for name, _ in shares])


# --- alerts ---------------------------------------------------------------------------------

def _alert_days(periods: DataFrame, alert_routes: DataFrame, alerts: DataFrame, dates: DateSet,
                all_days_from: DataFrame | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The requested days; the active periods as day intervals within their range, one row per period; and the bus
    informed entities with the alert's state, severities as 0/1 columns."""
    if all_days_from is not None and dates is None:
        days = date_frame(all_days_from, "service_date", None, "alert_date")
    else:
        days = date_frame(periods, "active_start", dates, "alert_date").select(F.to_date("alert_date").alias("alert_date"))
    active = clipped_days(periods.select("entity_id", "active_start", "active_end"), days, "active_start", "active_end")
    sev = F.coalesce(F.col("severity_level"), F.lit(""))
    state = alerts.select("entity_id", "static_version_date", F.lit(1).alias("alert_count"),
                          *[(sev == s.upper()).cast("int").alias(f"{s}_count") for s in SEVERITIES])
    bus = alert_routes.where(F.col("route_type") == BUS_ROUTE_TYPE).select("entity_id", "route_id", "stop_id")
    return days, active.select("entity_id", "first_day", "last_day"), bus.join(state, "entity_id")


SEVERITIES = ("severe", "warning", "info")
ALERT_COUNTS = ("alert_count", *(f"{s}_count" for s in SEVERITIES))


def mart_alerts_by_day(periods: DataFrame, alert_routes: DataFrame, alerts: DataFrame, routes: DataFrame,
                       dates: DateSet = None, run_days: DataFrame | None = None) -> DataFrame:
    """Distinct bus alerts active per (day, route), by severity.  An alert counts once per route and day however many
    periods or stops it has: its periods are united first, and it makes two rows per united period and route - a start
    and an end - whose running sums are the daily counts.  Days are spread over finished counts only."""
    days, active, bus = _alert_days(periods, alert_routes, alerts, dates, run_days)
    r = routes.select(F.col("feed_start_date").alias("static_version_date"), "route_id",
                      F.col("route_short_name").alias("route_name"))
    once = bus.join(r, ["route_id", "static_version_date"]).select("entity_id", "route_id", "route_name", *ALERT_COUNTS).distinct()
    rows = union_of_days(active, ["entity_id"]).join(once, "entity_id")
    out = daily_totals(rows, ["route_id", "route_name"], ALERT_COUNTS, days)
    return out.select("alert_date", "route_id", "route_name", *ALERT_COUNTS)


def mart_alerts_by_day_stops(periods: DataFrame, alert_routes: DataFrame, alerts: DataFrame,
                             stops: DataFrame, dates: DateSet = None,
                             run_days: DataFrame | None = None) -> DataFrame:
    """Distinct bus alerts active per (day, stop name), by severity, with the mean coordinates of the joined rows (each
    weighted by its number of active periods, as a row-level join would be).

    Counts follow united periods as in :func:`mart_alerts_by_day`; coordinates are summed per (alert, stop name) first
    and follow every single period.  Sums are decimals, so that what a period added is taken away exactly."""
    days, active, bus = _alert_days(periods, alert_routes, alerts, dates, run_days)
    s = stops.select(F.col("feed_start_date").alias("static_version_date"), "stop_id", "stop_name",
                     F.col("stop_lat").cast(COORD_SUM).alias("lat"), F.col("stop_lon").cast(COORD_SUM).alias("lon"))
    placed = bus.join(s, ["stop_id", "static_version_date"])
    per_alert = placed.groupBy("entity_id", "stop_name").agg(
        *[F.max(c).alias(c) for c in ALERT_COUNTS],
        *[f(c).alias(f"{c}_{n}") for c in ("lat", "lon") for n, f in (("sum", F.sum), ("n", F.count))])
    places = [f"{c}_{n}" for c in ("lat", "lon") for n in ("sum", "n")]
    zero = lambda names: [F.lit(0).cast(per_alert.schema[c].dataType).alias(c) for c in names]
    counted = union_of_days(active, ["entity_id"]).join(
        per_alert.select("entity_id", "stop_name", *ALERT_COUNTS, *zero(places)), "entity_id")
    located = active.join(per_alert.select("entity_id", "stop_name", *zero(ALERT_COUNTS), *places), "entity_id")
    out = daily_totals(counted.unionByName(located), ["stop_name"], [*ALERT_COUNTS, *places], days)
    mean = lambda c: F.round(F.col(f"{c}_sum").cast("double") / F.nullif(F.col(f"{c}_n"), F.lit(0)), COORD_DECIMALS)
    return out.select("alert_date", "stop_name", mean("lat").alias("stop_lat"), mean("lon").alias("stop_lon"), *ALERT_COUNTS)


# --- service delivered ------------------------------------------------------------------------

def day_versions(days: DataFrame, versions: DataFrame) -> DataFrame:
    """(trip_start_date, feed_start_date): the schedule version in force on each requested day."""
    return resolve_dates(days, "trip_start_date", versions).withColumnRenamed("static_version_date", "feed_start_date")


def _service_exceptions(calendar: DataFrame, calendar_dates: DataFrame, versions: DataFrame,
                        days: DataFrame, dv: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(weekly, added, removed) service ids per requested day under the version in force
    (``dv``: precomputed :func:`day_versions`, else resolved here).

    Weekly services: each calendar window is expanded to its days within the requested range
    (interval operator), then equi-joined on (version, day) with the version in force that day --
    only matching (service, day) pairs are ever produced."""
    dv = day_versions(days, versions) if dv is None else dv
    d = F.col("trip_start_date")
    windows = calendar.select("feed_start_date", "service_id", "start_date", "end_date",
                              *GTFS_WEEKDAY_COLUMNS.values())
    on_days = active_on_dates(windows, dv.select("trip_start_date"), "start_date", "end_date", "trip_start_date")
    weekly = (on_days.join(dv, ["trip_start_date", "feed_start_date"])
                     .where(weekday_flag(d, GTFS_WEEKDAY_COLUMNS) == F.lit(True))
                     .select("trip_start_date", "feed_start_date", "service_id"))
    exc = (calendar_dates.withColumnRenamed("date", "trip_start_date")
                         .join(dv, ["trip_start_date", "feed_start_date"])
                         .select("trip_start_date", "feed_start_date", "service_id", "exception_type"))
    added = exc.where(F.col("exception_type") == 1).drop("exception_type")
    removed = exc.where(F.col("exception_type") == 2).drop("exception_type")
    return weekly, added, removed


def service_union(calendar: DataFrame, calendar_dates: DataFrame, versions: DataFrame,
                  days: DataFrame, dv: DataFrame | None = None) -> DataFrame:
    """Weekly services within their window UNION (distinct) services added by exception."""
    weekly, added, _ = _service_exceptions(calendar, calendar_dates, versions, days, dv)
    return weekly.union(added).distinct()


def active_services(calendar: DataFrame, calendar_dates: DataFrame, versions: DataFrame,
                    days: DataFrame, dv: DataFrame | None = None) -> DataFrame:
    """Effective services per requested day under the version in force that day:
    (weekday services within their window  UNION  added exceptions)  minus removed exceptions.
    ``days`` has a ``trip_start_date`` column.  Output: (trip_start_date, feed_start_date, service_id)."""
    weekly, added, removed = _service_exceptions(calendar, calendar_dates, versions, days, dv)
    keys = ["trip_start_date", "feed_start_date", "service_id"]
    return weekly.union(added).distinct().join(removed, keys, "left_anti")


def first_departures(stop_times: DataFrame, versions_in_use: DataFrame | None = None) -> DataFrame:
    """Departure time at each trip's lowest stop sequence among stops with a departure time:
    (feed_start_date, trip_id, first_departure_time).  A min-by aggregate: partial per task."""
    st = stop_times.where(F.col("departure_time").isNotNull())
    if versions_in_use is not None:
        st = st.join(versions_in_use, "feed_start_date", "left_semi")
    return (st.groupBy("feed_start_date", "trip_id")
              .agg(F.min_by("departure_time", "stop_sequence").alias("first_departure_time")))


def scheduled_bus_trips(trips: DataFrame, routes: DataFrame, stop_times: DataFrame, calendar: DataFrame,
                        calendar_dates: DataFrame, versions: DataFrame, days: DataFrame,
                        dv: DataFrame | None = None) -> DataFrame:
    """Bus trips scheduled on each requested day whose first departure is before 24:00."""
    act = active_services(calendar, calendar_dates, versions, days, dv)
    return trips_of_services(trips, routes, stop_times, act)


def trips_of_services(trips: DataFrame, routes: DataFrame, stop_times: DataFrame, act: DataFrame) -> DataFrame:
    """Bus trips of the services ``act`` (trip_start_date, feed_start_date, service_id) whose first departure is
    before 24:00."""
    used = act.select("feed_start_date").distinct()
    first = first_departures(stop_times, used).where(hms_hour("first_departure_time") < 24)
    r = _bus_routes(routes).select("feed_start_date", "route_id", "route_name")
    # trips meet their first departures once a version; only then are they spread over the days they run
    bus = trips.select("feed_start_date", "trip_id", "route_id", "service_id", "direction_id").join(r, ["feed_start_date", "route_id"])
    t = (dealt(bus, "feed_start_date", "trip_id")
              .join(first.select("feed_start_date", "trip_id").hint("merge"), ["feed_start_date", "trip_id"])
              .join(act, ["feed_start_date", "service_id"]))
    return t.select(F.col("trip_start_date").alias("service_date"), "trip_start_date", "trip_id", "route_id",
                    "route_name", "direction_id", F.col("feed_start_date").alias("static_version_date"))


def mart_service_delivered(scheduled: DataFrame, fact_tu: DataFrame, dates: DateSet = None) -> DataFrame:
    """Share of scheduled bus service delivered per (day, route, direction).  Trips the realtime
    feed marks ADDED leave the denominator and are counted separately, under the feed's own route and direction;
    NULL direction is a group of its own.

    Scheduled trips and the fact (one row per day and trip) meet once, in a full outer join; a row counts as
    a scheduled trip, as an added one, or as both, and one aggregation follows.  Groups without scheduled trips go."""
    keys = ["trip_id", "trip_start_date", "static_version_date"]
    rt = where_opt(fact_tu, in_dates("trip_start_date", dates)).select(
        *keys, F.col("route_id").alias("rt_route"), F.col("direction_id").alias("rt_direction"),
        schedule_relationship("trip_schedule_rel").alias("rt_rel"), F.lit(True).alias("rt_seen"))
    planned = scheduled.select(*keys, "service_date", "route_id", "route_name", "direction_id", F.lit(True).alias("planned"))
    j = dealt(planned, *keys).join(rt, keys, "full_outer")
    status = delivery_status(F.col("rt_seen"), F.col("rt_rel"))
    marks = {"scheduled_trips": F.lit(1), "delivered_trips": (status == DELIVERED).cast("int"),
             "canceled_trips": (status == CANCELED).cast("int"), "no_rt_data_trips": (status == NO_RT_DATA).cast("int")}
    counts = [*marks, "added_trips"]
    as_planned = F.when(F.col("planned") & (status != ADDED), F.struct(
        "service_date", "route_id", "direction_id", "route_name", *[c.alias(n) for n, c in marks.items()],
        F.lit(0).alias("added_trips")))
    as_added = F.when(F.col("rt_rel") == ADDED, F.struct(
        F.col("trip_start_date").alias("service_date"), F.col("rt_route").alias("route_id"),
        F.col("rt_direction").alias("direction_id"), F.lit(None).cast("string").alias("route_name"),
        *[F.lit(0).alias(n) for n in marks], F.lit(1).alias("added_trips")))
    one = j.select("trip_start_date", "static_version_date", F.explode(F.array_compact(F.array(as_planned, as_added))).alias("x"))
    # counts alone first: with a text among the aggregates every trip would be sorted, not hashed
    keys = ["trip_start_date", "static_version_date", "service_date", "route_id", "direction_id"]
    named = one.select("trip_start_date", "static_version_date", "x.*").groupBy(*keys, "route_name").agg(
        *[F.sum(n).alias(n) for n in counts])
    agg = named.groupBy(*keys).agg(F.max("route_name").alias("route_name"), *[F.sum(n).alias(n) for n in counts])
    return agg.where("scheduled_trips > 0").select(
        "service_date", "trip_start_date", "route_id", "route_name", "direction_id", *counts,
        ratio_pct("delivered_trips", "scheduled_trips").alias("pct_delivered"), "static_version_date")
