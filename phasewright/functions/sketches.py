"""Quantile sketches stored by day, so that weeks and months merge without their events.

A KLL sketch answers quantiles of what it has seen within an error of rank and merges with others.
Exact percentiles stay the default of the measures; these are for periods over more rows than
one wants to read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 800  # size of a sketch: about 10 KB for a long day


def rank_error(k: int = K) -> float:
    """Error of rank that a quantile keeps within, 99 times in 100, as the sketch's authors fitted it."""
    return 2.296 / k**0.9723


def sketch(value: Column | str, k: int = K) -> Column:
    """Aggregate: the sketch of the values that are not null."""
    return F.kll_sketch_agg_double(value, k)


def merged(stored: Column | str) -> Column:
    """Aggregate: one sketch of many."""
    return F.kll_merge_agg_double(stored)


def seen(stored: Column | str) -> Column:
    return F.kll_sketch_get_n_double(stored)


def quantile(stored: Column | str, q: float) -> Column:
    """The value at rank ``q``; null for a sketch that has seen nothing."""
    return F.when(seen(stored) > 0, F.kll_sketch_get_quantile_double(stored, F.lit(q)))


def rank_errors(values: DataFrame, estimates: DataFrame, keys: list[str], value: str, estimate: str, q: float) -> DataFrame:
    """How far each estimate's rank among the exact values is from ``q``: ``keys``, ``n`` and ``error``, 0 where ``q`` lies within its ties."""
    met = values.where(F.col(value).isNotNull()).join(estimates.select(*keys, F.col(estimate).alias("_p")), keys)
    below, upto = F.count_if(F.col(value) < F.col("_p")), F.count_if(F.col(value) <= F.col("_p"))
    n = F.count(F.lit(1))
    return met.groupBy(*keys).agg(n.alias("n"), F.greatest(below / n - q, F.lit(q) - upto / n, F.lit(0.0)).alias("error"))
