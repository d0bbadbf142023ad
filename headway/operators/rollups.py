"""Aggregate expressions for rollups: coverage, status mix, null-aware weighted means.

All are plain aggregate Columns, so they ride on Spark's partial (map-side) + final hash
aggregation and a skewed group is pre-reduced before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions._cols import as_col
from headway.functions.transit import share_pct


def coverage_pct(c, scale: int = 2) -> Column:
    """Share of rows where ``c`` is reported: ``round(count(c) / count(*) * 100, scale)``."""
    return share_pct(F.count(as_col(c)), F.count(F.lit(1)), scale)


def status_share(c, value: str | None, scale: int = 2) -> Column:
    """Share of rows whose status equals ``value`` (``None`` = status is NULL)."""
    cond = as_col(c).isNull() if value is None else (as_col(c) == value)
    return share_pct(F.count_if(cond), F.count(F.lit(1)), scale)


def status_mix(c, categories: Mapping[str, str | None], scale: int = 2) -> list[Column]:
    """One share column per ``{output_name: status_value}``."""
    return [status_share(c, v, scale).alias(name) for name, v in categories.items()]


def weighted_mean(value, weight, null_aware: bool = True) -> Column:
    """``sum(value * weight) / sum(weight)``; with ``null_aware`` the denominator only counts the
    weight of rows whose value is present.  NULL when the denominator is 0."""
    v, w = as_col(value).cast("double"), as_col(weight).cast("double")
    den = F.sum(F.when(v.isNotNull(), w).otherwise(F.lit(0.0))) if null_aware else F.sum(w)
    return F.sum(v * w) / F.nullif(den, F.lit(0.0))


def mean_pct_of_flag(cond: Column) -> Column:
    """``avg(case when cond then 1 else 0) * 100`` as DOUBLE."""
    return F.avg(F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0))) * F.lit(100.0).cast("double")


# Occupancy status categories of GTFS-realtime and their report column names.
OCCUPANCY_STATUS_COLUMNS = {
    "pct_empty": "EMPTY",
    "pct_many_seats": "MANY_SEATS_AVAILABLE",
    "pct_few_seats": "FEW_SEATS_AVAILABLE",
    "pct_standing_room": "STANDING_ROOM_ONLY",
    "pct_crushed_standing": "CRUSHED_STANDING_ROOM_ONLY",
    "pct_full": "FULL",
    "pct_no_data_occupancy": None,
}
