"""Top-1-per-key operators (latest state, first event).

Both compile to ``row_number() = 1``, which Catalyst plans as a *partial* ``WindowGroupLimit``
before the shuffle and a final one after it: every map task forwards at most one row per key, so
a hot key (a third of all rows) costs one row per map partition in the exchange, not a third of
the data in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__headway_rn"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep, per ``keys``, the first row under ``order``.

    ``order`` should be total (end with a unique tie-break) for deterministic output.  State NULL
    placement explicitly (``asc_nulls_last`` / ``desc_nulls_last``): engines differ on defaults.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str = "snapshot_timestamp",
                   tiebreak: Sequence[Column] = (), nulls_first: bool = False) -> DataFrame:
    """Latest row per key by ``ts`` descending.

    ``nulls_first=True`` reproduces warehouses that sort NULL first in DESC order (a NULL
    timestamp then wins); the default keeps NULL last.
    """
    t = F.col(ts)
    o = t.desc_nulls_first() if nulls_first else t.desc_nulls_last()
    return first_per_key(df, keys, [o, *tiebreak])


def earliest_per_key(df: DataFrame, keys: Sequence[str], ts: str,
                     tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Earliest row per key by ``ts`` ascending, NULL timestamps last."""
    return first_per_key(df, keys, [F.col(ts).asc_nulls_last(), *tiebreak])
