"""Report queries over the marts (dashboard data work): trends, top-k rankings, route list.

Parameters are typed arguments, never interpolated text: ``start``/``end`` (inclusive dates, None
= open), ``routes`` (route names, None or empty = all), ``severities`` (subset of SEVERE, WARNING,
INFO).  Rankings use a total order (metric, then name) so ties are deterministic.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.operators import mean_pct_of_flag, numeric_first_order, top_k, weighted_mean
from headway.functions import ratio_pct

MEAN_DECIMALS = 9  # weighted means are rounded to 1e-9 to remove summation-order noise

# Severity -> mart count column.
SEVERITY_COLUMNS = {"SEVERE": "severe_count", "WARNING": "warning_count", "INFO": "info_count"}

_OCC_SHARES = ("pct_empty", "pct_many_seats", "pct_few_seats", "pct_standing_room",
               "pct_crushed_standing", "pct_full", "pct_no_data_occupancy")


def _range(df: DataFrame, col: str, start, end) -> DataFrame:
    c = F.col(col)
    if start is not None:
        df = df.where(c >= F.lit(_dt.date.fromisoformat(str(start))))
    if end is not None:
        df = df.where(c <= F.lit(_dt.date.fromisoformat(str(end))))
    return df


def _routes(df: DataFrame, col: str, routes: Sequence[str] | None) -> DataFrame:
    return df.where(F.col(col).isin(list(routes))) if routes else df


def _r(c: Column) -> Column:
    return F.round(c, MEAN_DECIMALS)


def bucket_column(start, end, single_day_col: str, multi_day_col: str, bucket: str | None = None) -> str:
    """Hour buckets for a single-day range, day buckets otherwise (or the explicit ``bucket``)."""
    if bucket is not None:
        return bucket
    return single_day_col if (start is not None and start == end) else multi_day_col


def occupancy_trend(occ: DataFrame, start=None, end=None, routes=None, bucket: str | None = None) -> DataFrame:
    b = bucket_column(start, end, "hour", "service_date", bucket)
    df = _routes(_range(occ, "service_date", start, end), "route_name", routes)
    n = F.col("snapshot_count")
    return (df.groupBy(F.col(b).alias("bucket"))
              .agg(F.sum(n).alias("snapshot_count"),
                   _r(weighted_mean("avg_occupancy_pct", n, null_aware=True)).alias("avg_occupancy_pct"),
                   *[_r(weighted_mean(c, n, null_aware=False)).alias(c) for c in _OCC_SHARES])
              .orderBy("bucket"))


def top_crowded_routes(occ: DataFrame, start=None, end=None, k: int = 10) -> DataFrame:
    df = _range(occ, "service_date", start, end).where(F.col("route_name").isNotNull())
    n = F.col("snapshot_count")
    agg = (df.groupBy("route_name")
             .agg(F.sum(n).alias("snapshot_count"),
                  _r(weighted_mean("avg_occupancy_pct", n, null_aware=True)).alias("avg_occupancy_pct"))
             .where(F.col("avg_occupancy_pct").isNotNull()))
    top = top_k(agg, k, [F.col("avg_occupancy_pct").desc(), F.col("route_name").asc()])
    return top.select(F.col("route_name").alias("route"), F.col("avg_occupancy_pct"),
                      F.col("snapshot_count").alias("data_points"))


def alerts_detail(alerts_day: DataFrame, start=None, end=None, routes=None) -> DataFrame:
    df = _routes(_range(alerts_day, "alert_date", start, end), "route_name", routes)
    return df.select("alert_date", "route_id", "route_name", "alert_count", "severe_count",
                     "warning_count", "info_count").orderBy(F.col("alert_date").desc())


def alerts_daily(alerts_day: DataFrame, start=None, end=None, routes=None) -> DataFrame:
    """Daily totals across routes (an alert on several routes counts once per route)."""
    df = alerts_detail(alerts_day, start, end, routes)
    return (df.groupBy("alert_date")
              .agg(*[F.sum(c).alias(c) for c in SEVERITY_COLUMNS.values()]))


def daily_total_scale(daily: DataFrame, severities: Sequence[str] = ("SEVERE", "WARNING", "INFO"),
                      ticks: int = 10) -> DataFrame:
    """Axis scale of the daily chart: the largest daily total and a tick step
    ``max(1, ceil(max / ticks))`` (one row)."""
    m = daily.agg(F.max(_severity_total(severities)).alias("max_daily_total"))
    return m.select("max_daily_total",
                    F.greatest(F.lit(1), F.ceil(F.col("max_daily_total") / ticks)).cast("int").alias("tick_step"))


def _severity_total(severities: Sequence[str]) -> Column:
    cols = [F.col(SEVERITY_COLUMNS[s]) for s in severities]
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return total


def top_alert_routes(alerts_day: DataFrame, start=None, end=None,
                     severities: Sequence[str] = ("SEVERE", "WARNING", "INFO"), k: int = 10) -> DataFrame:
    if not severities:
        raise ValueError("select at least one severity")
    df = _range(alerts_day, "alert_date", start, end)
    agg = df.groupBy("route_name").agg(*[F.sum(c).alias(c) for c in SEVERITY_COLUMNS.values()])
    agg = agg.withColumn("total", _severity_total(severities)).where(F.col("total") > 0)
    top = top_k(agg, k, [F.col("total").desc(), F.col("route_name").asc_nulls_last()])
    return top.select("route_name", "total", *SEVERITY_COLUMNS.values())


def alert_hotspots(alerts_stops: DataFrame, start=None, end=None) -> DataFrame:
    df = (_range(alerts_stops, "alert_date", start, end)
          .where(F.col("stop_lat").isNotNull() & F.col("stop_lon").isNotNull()))
    return df.groupBy("stop_name").agg(
        _r(F.avg("stop_lat")).alias("stop_lat"), _r(F.avg("stop_lon")).alias("stop_lon"),
        F.sum("alert_count").alias("alert_count"),
        *[F.sum(c).alias(c) for c in SEVERITY_COLUMNS.values()])


def top_alert_stops(alerts_stops: DataFrame, start=None, end=None,
                    severities: Sequence[str] = ("SEVERE", "WARNING", "INFO"), k: int = 10) -> DataFrame:
    if not severities:
        raise ValueError("select at least one severity")
    hot = alert_hotspots(alerts_stops, start, end)
    hot = hot.withColumn("total", _severity_total(severities)).where(F.col("total") > 0)
    top = top_k(hot, k, [F.col("total").desc(), F.col("stop_name").asc_nulls_last()])
    return top.select("stop_name", "stop_lat", "stop_lon", "total", *SEVERITY_COLUMNS.values())


def _otp_aggs() -> list[Column]:
    d = F.col("arrival_delay_seconds")
    return [F.count(F.lit(1)).alias("event_count"),
            _r(mean_pct_of_flag(F.col("is_on_time"))).alias("on_time_pct"),
            _r(mean_pct_of_flag(d < -150)).alias("early_pct"),
            _r(mean_pct_of_flag(d > 300)).alias("late_pct")]


def _otp_rows(stop_events: DataFrame, start, end) -> DataFrame:
    return (_range(stop_events, "trip_start_date", start, end)
            .where(F.col("is_on_time").isNotNull() & F.col("arrival_delay_seconds").isNotNull()))


def otp_trend(stop_events: DataFrame, start=None, end=None, routes=None, bucket: str | None = None) -> DataFrame:
    b = bucket_column(start, end, "hour", "trip_start_date", bucket)
    df = _routes(_otp_rows(stop_events, start, end), "route_name", routes).where(F.col("hour").isNotNull())
    return df.groupBy(F.col(b).alias("bucket")).agg(*_otp_aggs()).orderBy("bucket")


def worst_otp_routes(stop_events: DataFrame, start=None, end=None, min_events: int = 100, k: int = 10) -> DataFrame:
    df = _otp_rows(stop_events, start, end).where(F.col("route_name").isNotNull())
    agg = df.groupBy("route_name").agg(*_otp_aggs()).where(F.col("event_count") >= min_events)
    return top_k(agg, k, [F.col("on_time_pct").asc(), F.col("route_name").asc()])


def service_delivered_daily(svc: DataFrame, start=None, end=None, routes=None) -> DataFrame:
    df = _routes(_range(svc, "trip_start_date", start, end), "route_name", routes)
    counts = ("scheduled_trips", "delivered_trips", "canceled_trips", "no_rt_data_trips", "added_trips")
    daily = df.groupBy(F.col("trip_start_date").alias("bucket")).agg(*[F.sum(c).alias(c) for c in counts])
    return daily.select(
        "bucket", *counts,
        ratio_pct("delivered_trips", "scheduled_trips").alias("pct_delivered"),
        ratio_pct("canceled_trips", "scheduled_trips").alias("pct_canceled"),
        ratio_pct("no_rt_data_trips", "scheduled_trips").alias("pct_no_rt_data"),
        ratio_pct("added_trips", "scheduled_trips").alias("pct_added")).orderBy("bucket")


def ascending(top: DataFrame, metric: str, name: str) -> DataFrame:
    """A ranking in chart order: smallest metric first."""
    return top.orderBy(F.col(metric).asc(), F.col(name).desc())


def numbered(report: DataFrame, order: Sequence[Column]) -> DataFrame:
    """A finished report (a bounded number of rows) with its place in the order as a column."""
    return report.select(F.row_number().over(Window.orderBy(*order)).alias("place"), "*")


def route_list(occ: DataFrame) -> DataFrame:
    """Distinct (route_id, route_name) with a name, in numeric-first order."""
    df = occ.where(F.col("route_name").isNotNull()).select("route_id", "route_name").distinct()
    return df.orderBy(*numeric_first_order("route_name"), F.col("route_id").asc())
