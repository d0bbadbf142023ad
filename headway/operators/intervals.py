"""Interval-active expansion: which intervals are active on which dates of a requested set.

An interval ``[start, end]`` (timestamps, ``end`` may be NULL = open) is active on day ``d`` when
``to_date(start) <= d`` and (``end`` is NULL or ``to_date(end) >= d``).  For a date set we clip the
interval to the set's range ``[lo, hi]``, expand it to days with ``sequence`` and keep the days that
are in the set (equi semi-join on the day).  Output rows = matched (interval, day) pairs only; the
expansion is bounded by the requested range, not by the interval length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def active_on_dates(intervals: DataFrame, dates: DataFrame, start_col: str, end_col: str,
                    date_col: str = "alert_date") -> DataFrame:
    """Rows of ``intervals`` repeated once per date of ``dates[date_col]`` on which they are active;
    the date is added as ``date_col``."""
    days = dates.select(F.col(date_col)).where(F.col(date_col).isNotNull()).distinct()
    bounds = days.select(F.struct(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))).scalar()
    lo, hi = bounds.getField("lo"), bounds.getField("hi")
    s = F.to_date(F.col(start_col))
    e = F.to_date(F.col(end_col))
    first = F.greatest(s, lo)
    last = F.least(F.coalesce(e, hi), hi)
    # Filter before `sequence`: it counts down when start > stop.
    cand = intervals.where(s.isNotNull() & (s <= hi) & (e.isNull() | (e >= lo)) & (first <= last))
    expanded = cand.withColumn(date_col, F.explode(F.sequence(first, last)))
    return expanded.join(days, on=date_col, how="left_semi")


def clipped_days(intervals: DataFrame, dates: DataFrame, start_col: str, end_col: str, date_col: str = "alert_date",
                 first: str = "first_day", last: str = "last_day") -> DataFrame:
    """``intervals`` with their first and last active day within the range of ``dates[date_col]``; those without one go."""
    bounds = dates.select(F.struct(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))).scalar()
    lo, hi = bounds.getField("lo"), bounds.getField("hi")
    days = intervals.withColumn(first, F.greatest(F.to_date(start_col), lo)).withColumn(
        last, F.least(F.coalesce(F.to_date(end_col), hi), hi))
    return days.where(F.col(start_col).isNotNull() & (F.col(first) <= F.col(last)))


def union_of_days(intervals: DataFrame, keys: Sequence[str], first: str = "first_day", last: str = "last_day") -> DataFrame:
    """Per key the union of its day intervals, as intervals that neither overlap nor touch.  Intervals with one first
    day are reduced to the longest before the shuffle."""
    longest = intervals.groupBy(*keys, first).agg(F.max(last).alias(last))
    w = Window.partitionBy(*keys).orderBy(first)
    reach = F.max(last).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col(first) <= F.date_add(reach, 1), 0).otherwise(1)
    part = F.sum("new_run").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (longest.withColumn("new_run", new).withColumn("run", part).groupBy(*keys, "run")
            .agg(F.min(first).alias(first), F.max(last).alias(last)).drop("run"))


def daily_totals(rows: DataFrame, keys: Sequence[str], measures: Sequence[str], dates: DataFrame,
                 date_col: str = "alert_date", first: str = "first_day", last: str = "last_day") -> DataFrame:
    """Sums of ``measures`` over the rows whose day interval holds a date, per (key, date): rows are never repeated per day.

    A row adds its measures on its first day and takes them away after its last one; these changes are summed per (key,
    day), running sums over a key's changes (at most one a day) are its totals, and only a total whose first measure is
    above zero is repeated until the next change, for days of ``dates``."""
    change = F.explode(F.array(F.struct(F.col(first).alias("day"), F.lit(1).alias("sign")),
                               F.struct(F.date_add(last, 1).alias("day"), F.lit(-1).alias("sign"))))
    signed = rows.select(*keys, *measures, change.alias("c"))
    per_day = signed.groupBy(*keys, F.col("c.day").alias("day")).agg(
        *[F.sum(F.when(F.col("c.sign") > 0, F.col(m)).otherwise(-F.col(m))).alias(m) for m in measures])
    w = Window.partitionBy(*keys).orderBy("day")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = per_day.select(*keys, "day", F.lead("day").over(w).alias("until"), *[F.sum(m).over(upto).alias(m) for m in measures])
    live = totals.where(F.col(measures[0]) > 0)
    spread = live.select(*keys, *measures, F.explode(F.sequence("day", F.date_sub("until", 1))).alias(date_col))
    return spread.join(dates.select(date_col).distinct(), date_col, "left_semi")
