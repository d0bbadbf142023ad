"""Ordering operators: bounded top-k and the numeric-first route order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from headway.functions._cols import as_col


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """First ``k`` rows under ``order`` (planned as TakeOrderedAndProject: each task keeps its own
    top-k, only k rows per task reach the final merge).  Make ``order`` total for stable output."""
    return df.orderBy(*order).limit(k)


def numeric_first_order(c) -> list[Column]:
    """Sort keys: names that are integers first, numerically; others after, by text."""
    n = as_col(c).try_cast("int")
    return [n.isNull().asc(), n.asc_nulls_last(), as_col(c).asc_nulls_last()]
