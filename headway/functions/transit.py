"""Transit-domain column functions (predicates, classifications, ratios)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions._cols import as_col

# On-time window in seconds (early bound, late bound), inclusive.
ON_TIME_EARLY_SECONDS = -150
ON_TIME_LATE_SECONDS = 300

# Delivery classes.
DELIVERED, CANCELED, ADDED, NO_RT_DATA = "DELIVERED", "CANCELED", "ADDED", "NO_RT_DATA"

# The GTFS route_type of buses.
BUS_ROUTE_TYPE = 3


def not_deleted(c="is_deleted") -> Column:
    """Keep rows whose deletion flag is FALSE or NULL."""
    return ~F.coalesce(as_col(c), F.lit(False))


def is_on_time(delay, early: int = ON_TIME_EARLY_SECONDS, late: int = ON_TIME_LATE_SECONDS) -> Column:
    """TRUE when ``delay`` lies in [early, late]; NULL delay is FALSE (never NULL)."""
    return F.coalesce(as_col(delay).between(early, late), F.lit(False))


def schedule_relationship(c) -> Column:
    """Blank or NULL schedule relationship means SCHEDULED (the GTFS-realtime default)."""
    return F.coalesce(F.nullif(F.trim(as_col(c)), F.lit("")), F.lit("SCHEDULED"))


def delivery_status(rt_key, rel) -> Column:
    """Classify a scheduled trip by its matched realtime state (``rt_key`` NULL = no match)."""
    rel = as_col(rel)
    return (F.when(as_col(rt_key).isNull(), F.lit(NO_RT_DATA))
            .when(rel == CANCELED, F.lit(CANCELED))
            .when(rel == ADDED, F.lit(ADDED))
            .otherwise(F.lit(DELIVERED)))


def first_translation_text(c) -> Column:
    """Text of the first translation of a GTFS-realtime TranslatedString struct, NULL if none."""
    return F.try_element_at(as_col(c).getField("translation"), F.lit(1)).getField("text")


def first_translation_text_json(c) -> Column:
    """Same as :func:`first_translation_text` for a column holding the struct as JSON text."""
    return F.get_json_object(as_col(c), "$.translation[0].text")


def share_pct(part, whole, scale: int = 2) -> Column:
    """``round(part / whole * 100, scale)`` as DOUBLE; NULL when ``whole`` is 0 or NULL."""
    ratio = as_col(part).cast("double") / F.nullif(as_col(whole), F.lit(0)).cast("double")
    return F.round(ratio * F.lit(100.0).cast("double"), scale)


def ratio_pct(part, whole, scale: int = 2) -> Column:
    """``round(part * 100 / whole, scale)`` as DOUBLE (multiply first); NULL on zero whole."""
    num = as_col(part).cast("double") * F.lit(100.0).cast("double")
    return F.round(num / F.nullif(as_col(whole), F.lit(0)).cast("double"), scale)


def in_overnight_window(service_date, hour, trip_start_date, last_hour: int = 5) -> Column:
    """Snapshot belongs to the trip day: same day, or next day in hours 0..last_hour."""
    sd, td = as_col(service_date), as_col(trip_start_date)
    return (sd == td) | ((sd == F.date_add(td, 1)) & as_col(hour).between(0, last_hour))


def in_late_window(service_date, trip_start_date, days: int = 1) -> Column:
    """Snapshot was collected on the trip day or up to ``days`` later."""
    td = as_col(trip_start_date)
    return as_col(service_date).between(td, F.date_add(td, days))
