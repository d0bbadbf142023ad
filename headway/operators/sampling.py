"""Stride sampling of snapshot files: within each group (a landing hour), order the files by path
and keep every n-th, starting with the first.  Runs on a path-only listing (no content read)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stride_sample(files: DataFrame, group_cols: Sequence[str], order_col: str = "path",
                  n: int = 5, tiebreak: Sequence = ()) -> DataFrame:
    if n <= 1:
        return files
    w = Window.partitionBy(*group_cols).orderBy(F.col(order_col).asc_nulls_last(), *tiebreak)
    rn = F.row_number().over(w)
    return files.withColumn("__rn", rn).where((F.col("__rn") - 1) % n == 0).drop("__rn")
