"""Runs of equal or consecutive values (X05, X06) and completion of missing rows.

The run windows are for frames that are already one row per entity and period.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def run_length(df: DataFrame, keys: list[str], order: str, value: str, name: str) -> DataFrame:
    """Position of each row within its run of equal values."""
    w = Window.partitionBy(*keys).orderBy(order)
    starts = F.when(F.col(value).eqNullSafe(F.lag(value).over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    island = df.withColumn("_start", starts).withColumn("_island", F.sum("_start").over(w))
    inside = Window.partitionBy(*keys, "_island").orderBy(order)
    return island.withColumn(name, F.row_number().over(inside)).drop("_start", "_island")


def day_streak(df: DataFrame, keys: list[str], day: str, name: str) -> DataFrame:
    """Position of each row within its run of consecutive days."""
    w = Window.partitionBy(*keys).orderBy(day)
    gap = F.datediff(F.col(day), F.lag(day).over(w))
    island = df.withColumn("_start", F.when(gap <= 1, 0).otherwise(1)).withColumn("_island", F.sum("_start").over(w))
    position: Column = F.row_number().over(Window.partitionBy(*keys, "_island").orderBy(day))
    return island.withColumn(name, position).drop("_start", "_island")


def zero_streak_id(df: DataFrame, keys: list[str], order: str, value: str, name: str) -> DataFrame:
    """Index of the latest earlier row above zero; null on such rows and before the first."""
    w = Window.partitionBy(*keys).orderBy(order)
    index = F.row_number().over(w)
    indexed = df.withColumn("_hit", F.when(F.col(value) > 0, index))
    latest = F.last("_hit", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return indexed.withColumn(name, F.when(F.col(value) > 0, F.lit(None)).otherwise(latest)).drop("_hit")


def _range_of(df: DataFrame, period: str) -> Column:
    """First and last period of the frame as a scalar subquery."""
    return df.agg(F.struct(F.min(period).alias("lo"), F.max(period).alias("hi"))).scalar()


def complete_dates(df: DataFrame, keys: list[str], period: str, *, step: str = "interval 1 day") -> DataFrame:
    """Every key with every period from the frame's first to its last; other columns null where absent.

    Each key is exploded into its own sequence of periods, so the grid has as many rows
    as entities times periods of the report.
    """
    span = _range_of(df, period)
    keyed = df.select(*keys).distinct().withColumn("_span", span)
    grid = keyed.select(
        *keys, F.explode(F.sequence(F.col("_span.lo"), F.col("_span.hi"), F.expr(step))).alias(period)
    )
    return grid.join(df, [*keys, period], "left")


def complete_ints(df: DataFrame, keys: list[str], period: str) -> DataFrame:
    """Every key with every whole number from the frame's first to its last."""
    keyed = df.select(*keys).distinct().withColumn("_span", _range_of(df, period))
    grid = keyed.select(*keys, F.explode(F.sequence(F.col("_span.lo"), F.col("_span.hi"))).alias(period))
    return grid.join(df, [*keys, period], "left")


def complete_seen(df: DataFrame, keys: list[str], periods: list[str], fill: dict | None = None) -> DataFrame:
    """Every key with every period combination seen anywhere in the frame.

    The periods travel as one array, at most the calendar of the report.
    """
    seen = df.agg(F.collect_set(F.struct(*periods))).scalar()
    grid = (
        df.select(*keys).distinct().withColumn("_seen", seen)
        .select(*keys, F.explode("_seen").alias("_p"))
        .select(*keys, *[F.col(f"_p.{p}").alias(p) for p in periods])
    )
    out = grid.join(df, [*keys, *periods], "left")
    return out.fillna(fill) if fill else out
