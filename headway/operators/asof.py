"""As-of (backward) resolution of a versioned dimension: for a date ``d`` pick
``max(version) where version <= d``; NULL when no version is that old.

Plan: the version dimension (one row per published schedule) becomes validity intervals
``[valid_from, next valid_from)``, expanded to one row per covered day.  The last, open-ended
version covers only its own first day and callers clamp their date with ``least(d, last)``.  The
resolution is then a plain equi-join on the day: no range predicate, no nested loop, exactly one
match per row.  The day table grows with the calendar span of the schedule history (a few
thousand rows for a decade), never with the fact data, so the planner broadcasts it after its own
size check (auto-broadcast threshold / AQE runtime statistics).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions._cols import as_col

_DAY = "__asof_day"


def version_days(versions: DataFrame, version_col: str = "feed_start_date") -> DataFrame:
    """``(version, day)`` for every day a version is the current one, open end = its first day.

    The ``lead`` runs over the version dimension only (one row per published schedule version;
    its size follows the publication history, not the data).  A repeated version date keeps only
    its last copy (``next > v``), so duplicates cannot multiply days and no extra exchange is
    spent on a distinct."""
    v = versions.select(F.col(version_col).alias("__v")).where(F.col("__v").isNotNull())
    nxt = F.lead("__v").over(Window.orderBy("__v"))
    iv = v.withColumn("__next", nxt).where(F.col("__next").isNull() | (F.col("__next") > F.col("__v")))
    last_day = F.coalesce(F.date_sub(F.col("__next"), 1), F.col("__v"))
    return iv.select(F.col("__v").alias(version_col),
                     F.explode(F.sequence(F.col("__v"), last_day)).alias(_DAY))


def latest_version(versions: DataFrame, version_col: str = "feed_start_date") -> Column:
    """Scalar subquery: the newest version date."""
    return versions.select(F.max(version_col)).scalar()


def asof_version(df: DataFrame, date_col, versions: DataFrame, out_col: str = "static_version_date",
                 version_col: str = "feed_start_date") -> DataFrame:
    """Append ``out_col`` = newest version with ``version <= date_col`` (NULL if none)."""
    days = version_days(versions, version_col).withColumnRenamed(version_col, out_col)
    key = F.least(as_col(date_col), latest_version(versions, version_col))
    return (df.withColumn(_DAY, key)
              .join(days, on=_DAY, how="left")
              .drop(_DAY))


def resolve_dates(dates: DataFrame, date_col: str, versions: DataFrame,
                  out_col: str = "static_version_date", version_col: str = "feed_start_date") -> DataFrame:
    """Version per date for a (small) set of dates: ``(date_col, out_col)``."""
    return asof_version(dates.select(date_col).distinct(), date_col, versions, out_col, version_col)
