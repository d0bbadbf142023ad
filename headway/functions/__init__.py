"""Column functions (FN-*): JVM-side expressions only."""

from headway.functions.time import (  # noqa: F401
    GTFS_WEEKDAY_COLUMNS,
    epoch_to_local_ntz,
    epoch_to_utc_ntz,
    hms_hour,
    hms_to_seconds,
    hours_by_minute_boundaries,
    minute_boundaries_between,
    ntz_epoch_seconds,
    seconds_since_day_start,
    weekday_flag,
    yyyymmdd_to_date,
)
from headway.functions.transit import (  # noqa: F401
    ADDED,
    BUS_ROUTE_TYPE,
    CANCELED,
    DELIVERED,
    NO_RT_DATA,
    delivery_status,
    first_translation_text,
    first_translation_text_json,
    in_late_window,
    in_overnight_window,
    is_on_time,
    not_deleted,
    ratio_pct,
    schedule_relationship,
    share_pct,
)
