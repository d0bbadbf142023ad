"""Data-quality report for declared constraints (keys are declared, not enforced, in the source
warehouse): duplicate primary keys, NULL key columns, orphan foreign keys.

All checks are one grouping.  A table is scanned once: each row makes one (constraint, key, side) row per primary key and
per foreign key that the table is child or parent of; keys are arrays of the columns' texts, so they are compared whole.  Counts per
(constraint, key) - pre-aggregated in each task, so a key that a third of all rows share is one row per task - tell
duplicates, NULLs and children without a parent; no join is needed.  The report is ``(table_name, check_name, violations)``.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.schemas import FOREIGN_KEYS, PRIMARY_KEYS

CHILD, PARENT = 0, 1


def _constraints(tables: Mapping[str, DataFrame]) -> list[tuple]:
    """(name of the check, child table, its columns, parent table, its columns); no parent: a primary key."""
    out = [("key", t, PRIMARY_KEYS[t], None, ()) for t in tables if t in PRIMARY_KEYS]
    out += [(f"orphan_{'_'.join(cols)}", child, cols, parent, pcols) for child, cols, parent, pcols in FOREIGN_KEYS
            if child in tables and parent in tables]
    return [c for c in out if set(c[2]) <= set(tables[c[1]].columns) and (c[3] is None or set(c[4]) <= set(tables[c[3]].columns))]


def _key(cols) -> Column:
    return F.array(*[F.col(c).cast("string") for c in cols])


def key_rows(tables: Mapping[str, DataFrame], constraints: list[tuple]) -> DataFrame:
    """One row per row of a table and constraint it takes part in: number of the constraint, key, side."""
    parts = []
    for name, df in tables.items():
        made = [F.struct(F.lit(i).alias("no"), _key(cols).alias("key"), F.lit(side).alias("side"))
                for i, (_, child, ccols, parent, pcols) in enumerate(constraints)
                for table, cols, side in ((child, ccols, CHILD), (parent, pcols, PARENT)) if table == name]
        if made:
            parts.append(df.select(F.inline(F.array(*made))))
    return reduce(DataFrame.unionAll, parts)


def quality_report(tables: Mapping[str, DataFrame], extra: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Run every applicable check over ``tables`` (name -> DataFrame).  ``extra`` adds
    precomputed ``violations`` aggregates keyed by ``"table:check"``."""
    constraints = _constraints(tables)
    groups = key_rows(tables, constraints).groupBy("no", "key").agg(
        F.count_if(F.col("side") == CHILD).alias("n"), F.count_if(F.col("side") == PARENT).alias("parents"))
    null = F.exists("key", lambda x: x.isNull())
    found = groups.groupBy("no").agg(
        F.count_if(F.col("n") > 1).alias("duplicate"), F.coalesce(F.sum(F.when(null, F.col("n"))), F.lit(0)).alias("missing"),
        F.coalesce(F.sum(F.when(~null & (F.col("parents") == 0), F.col("n"))), F.lit(0)).alias("orphan"))
    checks = [(i, child, name, measure) for i, (check, child, _, _, _) in enumerate(constraints)
              for name, measure in ((("duplicate_key", "duplicate"), ("null_key", "missing")) if check == "key" else ((check, "orphan"),))]
    named = F.inline(F.array(*[F.struct(F.lit(i).alias("check_no"), F.lit(t).alias("table_name"), F.lit(n).alias("check_name"),
                                        F.lit(m).alias("measure")) for i, t, n, m in checks]))
    value = F.coalesce(*[F.when(F.col("measure") == m, F.col(m)) for m in ("duplicate", "missing", "orphan")], F.lit(0))
    # tables without rows have no group: their checks are there with nothing found
    wanted = groups.sparkSession.range(1).select(named)
    out = wanted.join(found, F.col("check_no") == F.col("no"), "left").select("table_name", "check_name", value.cast("bigint").alias("violations"))
    for key, agg in (extra or {}).items():
        t, chk = key.split(":", 1)
        out = out.unionByName(agg.select(F.lit(t).alias("table_name"), F.lit(chk).alias("check_name"),
                                         F.col("violations").cast("bigint").alias("violations")))
    return out


def periods_without_start(raw_alerts: DataFrame) -> DataFrame:
    """Active periods of not-deleted alerts that lack a start (dropped by the fact build)."""
    from headway.functions import not_deleted

    ap = raw_alerts.where(not_deleted("is_deleted")).select(F.explode("active_period").alias("p"))
    return ap.agg(F.count_if(F.col("p.start").isNull()).alias("violations"))
