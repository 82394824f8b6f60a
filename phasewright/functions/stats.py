"""Weighted means and period-over-period change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def wmean(value, weight) -> Column:
    """sum(v*w) / sum(w) over the rows where v is present; null when there are none."""
    v = F.col(value) if isinstance(value, str) else value
    w = F.col(weight) if isinstance(weight, str) else weight
    return F.try_divide(F.sum(v * w), F.sum(F.when(v.isNotNull(), w)))


def change(value, previous) -> Column:
    return F.try_divide(value - previous, previous)


def with_delta(df: DataFrame, var: str, entity: list[str], period: str) -> DataFrame:
    """Relative change from the entity's previous row.

    The frame must already be aggregated to one row per entity and period, so a
    window partition is as long as the report and does not grow with the raw data.
    """
    w = Window.partitionBy(*entity).orderBy(period)
    return df.withColumn("delta", change(F.col(var), F.lag(var).over(w)))


def sum0(c) -> Column:
    """Sum that is 0 when every value is missing."""
    return F.coalesce(F.sum(c), F.lit(0))
