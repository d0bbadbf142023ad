"""Daily jobs over a warehouse folder: landed files -> RAW -> STATIC -> FACT -> MART tables.

Each job takes a set of days (a backfill of many days is one call) and replaces exactly the
slices those days own, so re-running a job is idempotent:

* :func:`load_realtime` -- snapshot files of one feed -> RAW table (day slices; trip updates
  read only the strided files);
* :func:`load_static` -- one GTFS version folder -> the eight DIM tables (version slice);
* :func:`build_facts` -- RAW -> FACT_VEHICLE_POSITIONS / FACT_TRIP_UPDATES (trip-day slices) and
  the three alert facts (guarded upsert into snapshot tables);
* :func:`build_marts` -- FACT -> the five METRIC tables (their day slices).

* :func:`run` -- one scheduled run: :func:`plan_run` turns the run day and the RAW slices that changed since the last run
  into the day sets of each layer, so a late slice rebuilds exactly the days it touches.

Warehouse layout: ``<root>/<table>`` are tables with manifests (:mod:`headway.sinks.tables`): days or schedule versions
as slices, alert facts in hash buckets; ``<root>/_RUN-<n>`` records the runs.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.plans import facts, marts, raw
from headway.plans._common import as_dates, lagged_day
from headway.plans.static import load_static_version
from headway.schemas import LAYOUT, conform, schema
from headway.sinks import tables as sinks
from headway.sources import gtfs_static

ALERT_FACT_KEYS = {"fact_alerts": ["entity_id"], "fact_alerts_routes": ["entity_id", "route_id", "stop_id"],
                   "fact_alerts_active_periods": ["entity_id", "period_index"]}


RAW_LAG, FACT_LAG = 1, 2        # days after which a day's landing, and its late snapshots, are complete
RUN = "_RUN"


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        if table in ALERT_FACT_KEYS:
            cur = sinks.read_current(self.spark, self.path(table))
            return cur if cur is not None else self.spark.createDataFrame([], schema(table))
        if not sinks.path_exists(self.spark, self.path(table)):
            return self.spark.createDataFrame([], schema(table))
        return sinks.read_table(self.spark, self.path(table), schema(table))

    def replace(self, df: DataFrame, table: str, day_col: str, days: Iterable[_dt.date]) -> None:
        """Make the requested day slices of ``table`` (all sub-partitions) equal to ``df``."""
        part, cluster = LAYOUT[table]
        sinks.replace_slices(conform(df, table), self.path(table), part, [{day_col: d} for d in days], cluster)


def load_realtime(wh: Warehouse, landing_root: str, feed: str, days, stride: int = 5) -> None:
    """Snapshot files of ``feed`` landed on ``days`` -> RAW table day slices."""
    ds = as_dates(days)
    rows = raw.raw_from_landed(wh.spark, landing_root, feed, [d.isoformat() for d in ds], stride)
    wh.replace(rows, f"raw_{feed}", "service_date", ds)


def load_static(wh: Warehouse, static_root: str, collected_on: str | None = None) -> str | None:
    """Load the GTFS version folder collected on ``collected_on`` (``YYYYMMDD``; newest folder of
    that day) or the newest folder overall.  Returns the folder loaded, or None."""
    vdir = (gtfs_static.version_dir_for_date(wh.spark, static_root, collected_on) if collected_on
            else gtfs_static.latest_version_dir(wh.spark, static_root))
    if vdir is not None:
        load_static_version(wh.spark, vdir, wh.root)
    return vdir


def build_facts(wh: Warehouse, days, alert_days=None) -> None:
    """FACT tables for trips starting on ``days`` (RAW of those days and the next one are read); alert facts from the RAW
    alerts of ``alert_days`` (default: the same days)."""
    ds = as_dates(days)
    alert_ds = as_dates(days if alert_days is None else alert_days)
    versions = wh.read("dim_static_versions").select("feed_start_date")
    fvp = facts.fact_vehicle_positions(wh.read("raw_vehicle_positions"), versions, ds)
    wh.replace(fvp, "fact_vehicle_positions", "trip_start_date", ds)
    ftu = facts.fact_trip_updates(wh.read("raw_trip_updates"), versions, ds)
    wh.replace(ftu, "fact_trip_updates", "trip_start_date", ds)
    ra = wh.read("raw_alerts")
    sources = {"fact_alerts": facts.fact_alerts(ra, versions, alert_ds),
               "fact_alerts_routes": facts.fact_alerts_routes(ra, alert_ds),
               "fact_alerts_active_periods": facts.fact_alerts_active_periods(ra, alert_ds)}
    for table, src in sources.items():
        sinks.upsert_table(src, wh.path(table), ALERT_FACT_KEYS[table])


def build_marts(wh: Warehouse, days, service_days=None, alert_days=None) -> None:
    """METRIC tables from the current FACT tables: stop events and service by trip days ``days``, occupancy by
    ``service_days``, alerts by ``alert_days`` (default: the same days)."""
    ds = as_dates(days)
    service_ds = as_dates(days if service_days is None else service_days)
    alert_ds = as_dates(days if alert_days is None else alert_days)
    versions = wh.read("dim_static_versions").select("feed_start_date")
    routes, stops, stop_times = wh.read("dim_routes"), wh.read("dim_stops"), wh.read("dim_stop_times")
    fvp = wh.read("fact_vehicle_positions")
    wh.replace(marts.mart_stop_events(fvp, stop_times, routes, ds), "metric_stop_events", "trip_start_date", ds)
    wh.replace(marts.mart_occupancy_route_hour(fvp, routes, service_ds), "metric_occupancy_route_hour", "service_date",
               service_ds)
    periods, far, fa = (wh.read("fact_alerts_active_periods"), wh.read("fact_alerts_routes"),
                        wh.read("fact_alerts"))
    wh.replace(marts.mart_alerts_by_day(periods, far, fa, routes, alert_ds), "metric_alerts_by_day", "alert_date", alert_ds)
    wh.replace(marts.mart_alerts_by_day_stops(periods, far, fa, stops, alert_ds), "metric_alerts_by_day_stops",
               "alert_date", alert_ds)
    day_frame = wh.spark.range(1).select(F.explode(F.array(*[F.lit(d) for d in ds])).alias("trip_start_date"))
    sched = marts.scheduled_bus_trips(wh.read("dim_trips"), routes, stop_times, wh.read("dim_calendar"),
                                      wh.read("dim_calendar_dates"), versions, day_frame)
    wh.replace(marts.mart_service_delivered(sched, wh.read("fact_trip_updates"), ds), "metric_service_delivered",
               "trip_start_date", ds)


# --- scheduled runs -------------------------------------------------------------------------------

@dataclass(frozen=True)
class RunPlan:
    """Days that a run builds, per layer: trip days of the facts and of stop events and service, service days of
    occupancy, alert days."""
    trip_days: tuple[_dt.date, ...]
    service_days: tuple[_dt.date, ...]
    alert_days: tuple[_dt.date, ...]
    until: _dt.date


def _raw_changes(wh: Warehouse, table: str, seen: dict) -> set[_dt.date]:
    names = sinks.changed_slices(wh.spark, wh.path(table), seen.get(table))
    return {_dt.date.fromisoformat(n.split("=", 1)[1]) for n in names}


def _days(first: _dt.date, last: _dt.date) -> set[_dt.date]:
    return {first + _dt.timedelta(days=i) for i in range((last - first).days + 1)}


def plan_run(wh: Warehouse, run_day) -> RunPlan:
    """Days due on ``run_day``: those that became complete since the last run (``FACT_LAG`` days ago or earlier), and of
    earlier ones what a RAW slice that changed since then touches - a RAW day holds rows of trips of that day and of
    the day before, and is the only source of its own service and alert day."""
    until = lagged_day(run_day, FACT_LAG)
    last = sinks.newest_record(wh.spark, wh.root, RUN)
    seen = last[1]["manifests"] if last else {}
    due = _days(_dt.date.fromisoformat(last[1]["until"]) + _dt.timedelta(days=1), until) if last else {until}
    positions, updates, alerts = (_raw_changes(wh, t, seen) for t in RAW_TABLES)
    one = _dt.timedelta(days=1)
    trips = {x for d in positions | updates for x in (d, d - one)}
    ready = lambda days: tuple(sorted(d for d in days | due if d <= until))
    return RunPlan(ready(trips), ready(positions), ready(alerts), until)


RAW_TABLES = ("raw_vehicle_positions", "raw_trip_updates", "raw_alerts")


def record_run(wh: Warehouse, plan: RunPlan, seen: dict) -> None:
    sinks.add_record(wh.spark, wh.root, RUN, {"until": plan.until.isoformat(), "manifests": seen})


def run(wh: Warehouse, landing_root: str, static_root: str, run_day, feeds=("vehicle_positions", "trip_updates", "alerts")) -> RunPlan:
    """One scheduled run: the newest schedule, RAW of the days landed since the last run, then what :func:`plan_run`
    finds due.  A run that fails is not recorded; the next one builds its days too."""
    load_static(wh, static_root)
    landed = lagged_day(run_day, RAW_LAG)
    last = sinks.newest_record(wh.spark, wh.root, RUN)
    since = _dt.date.fromisoformat(last[1]["until"]) + _dt.timedelta(days=FACT_LAG - RAW_LAG + 1) if last else landed
    for feed in feeds:
        load_realtime(wh, landing_root, feed, sorted(_days(since, landed)))
    seen = {}
    for t in RAW_TABLES:                                 # read before the plan: a slice loaded meanwhile is seen next time
        m = sinks.current_manifest(wh.spark, wh.path(t))
        if m is not None:
            seen[t] = m.number
    plan = plan_run(wh, run_day)
    build_facts(wh, plan.trip_days, plan.alert_days)
    build_marts(wh, plan.trip_days, plan.service_days, plan.alert_days)
    record_run(wh, plan, seen)
    return plan
