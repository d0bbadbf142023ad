from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DateSet = Iterable[str | _dt.date] | None


def as_dates(dates: DateSet) -> list[_dt.date] | None:
    if dates is None:
        return None
    out = []
    for d in dates:
        out.append(d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d)))
    return sorted(set(out))


def in_dates(col: str | Column, dates: DateSet, shift_days: Iterable[int] = (0,)) -> Column | None:
    """``col IN (dates shifted by each of shift_days)`` or None when all dates are requested."""
    ds = as_dates(dates)
    if ds is None:
        return None
    c = F.col(col) if isinstance(col, str) else col
    vals = sorted({d + _dt.timedelta(days=s) for d in ds for s in shift_days})
    return c.isin([F.lit(v) for v in vals])


def where_opt(df: DataFrame, cond: Column | None) -> DataFrame:
    return df if cond is None else df.where(cond)


def col_or_null(df: DataFrame, name: str, dtype: str) -> Column:
    """Column ``name`` if the frame has it, else a typed NULL (schema conformance)."""
    if name in df.columns:
        return F.col(name).cast(dtype).alias(name)
    return F.lit(None).cast(dtype).alias(name)


def date_frame(df: DataFrame, col: str, dates: DateSet, out: str | None = None) -> DataFrame:
    """The requested date set as a one-column DataFrame: the given dates, or every distinct value
    of ``df[col]`` when ``dates`` is None."""
    out = out or col
    ds = as_dates(dates)
    if ds is None:
        return df.select(F.col(col).alias(out)).where(F.col(out).isNotNull()).distinct()
    spark = df.sparkSession
    arr = F.array(*[F.lit(d) for d in ds])
    return spark.range(1).select(F.explode(arr).alias(out))


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by ``keys`` over all shuffle partitions of the session.  Adaptive execution merges shuffled partitions
    until a few tasks hold all rows, and a join sorts what its task holds; partitions that were asked for stay."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def dealt_splits(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of file splits dealt by ``keys`` before tasks sort them: a split has a whole row group at least, and some writers
    put a whole table into one.  Shuffles of more partitions than the bypass threshold gather a task's rows in memory, so
    there are no more."""
    conf = df.sparkSession.conf
    most = int(conf.get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    return df.repartition(max(1, min(int(conf.get("spark.sql.shuffle.partitions")), most)), *keys)


def lagged_day(run_day: str | _dt.date, lag_days: int) -> _dt.date:
    """The data day a scheduled run processes: ``run_day - lag_days`` (RAW loads lag one day, facts
    and marts two, so late snapshots have landed)."""
    d = run_day if isinstance(run_day, _dt.date) else _dt.date.fromisoformat(str(run_day))
    return d - _dt.timedelta(days=lag_days)
