"""Reusable DataFrame operators."""

from headway.operators.asof import asof_version, resolve_dates, version_days  # noqa: F401
from headway.operators.dedupe import earliest_per_key, first_per_key, latest_per_key  # noqa: F401
from headway.operators.intervals import (  # noqa: F401
    active_on_dates,
    clipped_days,
    daily_totals,
    union_of_days,
)
from headway.operators.ordering import numeric_first_order, top_k  # noqa: F401
from headway.operators.rollups import (  # noqa: F401
    OCCUPANCY_STATUS_COLUMNS,
    coverage_pct,
    mean_pct_of_flag,
    status_mix,
    status_share,
    weighted_mean,
)
from headway.operators.sampling import stride_sample  # noqa: F401
from headway.operators.upsert import collapse_slices, upsert_latest  # noqa: F401
