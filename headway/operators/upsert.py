"""Guarded latest-wins upsert (MERGE ... WHEN MATCHED AND src.ts > tgt.ts THEN UPDATE WHEN NOT
MATCHED THEN INSERT) as a pure DataFrame transformation.

Semantics per key:
* key only in target -> target row (upserts never delete);
* key only in source -> source row;
* both -> source row iff ``source.ts > target.ts`` (strict, both non-NULL), else target row.

Plan: one full outer join on the key columns (both sides unique per key, so a hot key cannot
skew the join), then a per-row choice.  Many source slices (a backfill of many days) are first
reduced to one row per key with :func:`collapse_slices`, which equals applying the slices one after
another in ascending slice order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.operators.dedupe import first_per_key


def collapse_slices(source: DataFrame, keys: Sequence[str], ts: str, slice_col: str,
                    tiebreak: Sequence = ()) -> DataFrame:
    """One row per key from many slices: newest ``ts``; on equal ``ts`` the earliest slice wins
    (it would have been applied first and the strict guard keeps it)."""
    return first_per_key(source, keys,
                         [F.col(ts).desc_nulls_last(), F.col(slice_col).asc_nulls_last(), *tiebreak])


def upsert_latest(target: DataFrame | None, source: DataFrame, keys: Sequence[str],
                  ts: str = "snapshot_timestamp") -> DataFrame:
    """Apply a deduplicated ``source`` to ``target`` with the strict timestamp guard."""
    cols = source.columns
    if target is None:
        return source
    missing = [c for c in cols if c not in target.columns]
    if missing:
        raise ValueError(f"target lacks columns {missing}")
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in cols])
    s = source.select(*[F.col(c).alias(f"s__{c}") for c in cols], F.lit(True).alias("s__present"))
    cond = [F.col(f"t__{k}") == F.col(f"s__{k}") for k in keys]
    j = t.join(s, on=cond, how="full_outer")
    take_source = F.col("s__present").isNotNull() & (
        F.col(f"t__{keys[0]}").isNull()
        | F.coalesce(F.col(f"s__{ts}") > F.col(f"t__{ts}"), F.lit(False)))
    return j.select(*[F.when(take_source, F.col(f"s__{c}")).otherwise(F.col(f"t__{c}")).alias(c)
                      for c in cols])
