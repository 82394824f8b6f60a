"""Health of pedestrian push-buttons."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phasewright.functions.calendar import week
from phasewright.operators.runs import complete_seen, zero_streak_id

INPUT = ["SignalID", "Detector", "CallPhase"]


def presses_too_high(paph: DataFrame, start) -> DataFrame:
    """Input-days with implausibly many presses.

    Three tests: hourly mean over 600 or deviation over 9000 from 6 to 22; before 6 an
    hour over 300 or a third-largest over 60; four hours over 300 that are also over a
    hundred times the second-largest input of the signal.
    """
    hours = paph.where(F.col("Date") >= F.lit(start).cast("date")).select(*INPUT, "Date", "Hour", "paph")
    of_day = F.hour("Hour")
    day = [*INPUT, "Date"]

    daytime = complete_seen(hours.where(of_day.between(6, 22)), INPUT, ["Date", "Hour"], {"paph": 0})
    spread = daytime.groupBy(*day).agg(F.avg("paph").alias("mn"), F.stddev_samp("paph").alias("sd")).where("mn > 600 or sd > 9000")

    # At most six hours a day: the sorted array is bounded.
    night = hours.where(of_day < 6).groupBy(*day).agg(F.sort_array(F.collect_list("paph"), asc=False).alias("v"))
    early = night.where((F.get("v", F.lit(0)) > 300) | (F.get("v", F.lit(2)) > 60))

    every = complete_seen(hours, INPUT, ["Date", "Hour"], {"paph": 0})
    w = Window.partitionBy("SignalID", "Hour").orderBy(F.desc("paph"))
    second = F.max(F.when(F.col("_rn") == 2, F.col("paph"))).over(Window.partitionBy("SignalID", "Hour"))
    ranked = every.withColumn("_rn", F.row_number().over(w)).withColumn("_second", second)
    # A lone input has no second-largest: the comparison stays unknown and does not count.
    outlier = (F.col("paph") > 300) & F.when(
        F.col("_second").isNotNull(), F.col("paph") > F.greatest(F.lit(1), F.col("_second")) * 100
    )
    crowd = ranked.groupBy(*day).agg(F.count_if(outlier).alias("n")).where("n >= 4")

    flagged = [d.select(*day) for d in (spread, early, crowd)]
    return reduce(DataFrame.unionByName, flagged).distinct().withColumn("toohigh", F.lit(True))


def regularized_gamma(shape: np.ndarray, x: np.ndarray) -> np.ndarray:
    """P(shape, x) by its power series, or the continued fraction of the complement."""
    out = np.full(len(shape), np.nan)
    usable = (shape > 0) & (x >= 0) & np.isfinite(shape) & np.isfinite(x)
    out[usable & (x == 0)] = 0.0
    usable &= x > 0
    low, high = usable & (x < shape + 1), usable & (x >= shape + 1)
    scale = lambda a, v: np.exp(a * np.log(v) - v - _log_gamma(a))
    if low.any():
        out[low] = _series(shape[low], x[low]) * scale(shape[low], x[low])
    if high.any():
        out[high] = 1 - _fraction(shape[high], x[high]) * scale(shape[high], x[high])
    return out


def _log_gamma(a: np.ndarray) -> np.ndarray:
    return np.fromiter(map(math.lgamma, a), float, len(a))


def _series(a: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Power series of the lower function; terms shrink from the start as v < a + 1, so it ends."""
    n, term = a.copy(), 1.0 / a
    total = term.copy()
    while (term >= total * 1e-16).any():
        n += 1
        term = term * v / n
        total += term
    return total


def _fraction(a: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Continued fraction of the upper function, until every step is 1 to working precision."""
    tiny = 1e-300
    b = v + 1 - a
    c, d = np.full(len(a), 1 / tiny), 1 / b
    h, k = d.copy(), 0
    live = np.ones(len(a), bool)
    while live.any():
        k += 1
        an = -k * (k - a)
        b = b + 2
        d, c = an * d + b, b + an / c
        d, c = np.where(np.abs(d) < tiny, tiny, d), np.where(np.abs(c) < tiny, tiny, c)
        d = 1 / d
        step = d * c
        h = np.where(live, h * step, h)
        # rounding keeps some steps a few units away from 1
        live &= np.abs(step - 1) >= 4e-16 * max(1, k)
    return h


@F.pandas_udf(T.DoubleType())
def gamma_cdf(shape: pd.Series, x: pd.Series) -> pd.Series:
    return pd.Series(regularized_gamma(shape.to_numpy(float), x.to_numpy(float)))


def low_press_probability(papd: DataFrame, keys: list[str]) -> DataFrame:
    """Chance of at most one press in a day, from a gamma fitted by moments.

    The moments are native aggregates; only one number per key reaches Python. Keys
    with two days or fewer have no fit; all-zero keys and failed fits have chance 1.
    """
    m, v = F.avg("papd"), F.var_pop("papd")
    fits = papd.groupBy(*keys).agg(F.count("*").alias("_n"), m.alias("_m"), v.alias("_v"), F.max("papd").alias("_max")).where("_n > 2")
    shape, rate = F.try_divide(F.col("_m") * F.col("_m"), F.col("_v")), F.try_divide("_m", "_v")
    cdf = gamma_cdf(F.coalesce(shape, F.lit(0.0)), F.coalesce(rate, F.lit(0.0)))
    return fits.withColumn("_cdf", cdf).select(
        *keys, F.when((F.col("_max") == 0) | F.col("_cdf").isNull() | F.isnan("_cdf"), 1.0).otherwise(F.col("_cdf")).alias("p0")
    )


def ped_uptime(
    papd: DataFrame, paph: DataFrame, corridors: DataFrame, calc_start, report_start, report_end, ped_config: DataFrame | None = None
) -> DataFrame:
    """Push-button uptime by day: 0 where a run of silent days is too unlikely or presses are too high.

    Every input has every day from the month six months before ``report_end`` (or from
    ``calc_start``, if that is earlier) to ``report_end``, with 0 presses where there are none.

    The probability uses the whole run, later days included. Windows run over one row
    per input and day.
    """
    daily = papd.select(*INPUT, "Date", "papd")
    if ped_config is not None:
        known = daily.select("SignalID").distinct()
        days = daily.select("Date").distinct()
        listed = ped_config.join(known, "SignalID", "left_semi").join(days, "Date", "left_semi").select(*INPUT, "Date").distinct()
        daily = daily.join(listed, [*INPUT, "Date"], "full_outer")
    daily = daily.where("CallPhase <> 0")
    end = F.lit(report_end).cast("date")
    first = F.least(F.lit(calc_start).cast("date"), F.trunc(F.add_months(end, -6), "month"))
    days = daily.select(*INPUT).distinct().select(*INPUT, F.explode(F.sequence(first, end)).alias("Date"))
    daily = days.join(daily, [*INPUT, "Date"], "left").na.fill({"papd": 0}).withColumn("weekday", F.dayofweek("Date").between(2, 6))
    daily = zero_streak_id(daily, INPUT, "Date", "papd", "streak_id")
    since = corridors.groupBy("SignalID").agg(F.min("Asof").alias("_asof"))
    daily = daily.join(since, "SignalID", "left").where(
        F.col("Date") >= F.greatest(F.lit(report_start).cast("date"), F.coalesce(F.col("_asof"), F.lit("1900-01-01").cast("date")))
    ).drop("_asof")
    fits = low_press_probability(daily, [*INPUT, "weekday"])
    rows = daily.join(fits, [*INPUT, "weekday"], "left")
    run = Window.partitionBy(*INPUT, "streak_id")
    chance = F.when(~F.bool_or(F.col("p0").isNull()).over(run), F.product("p0").over(run))
    rows = rows.withColumn("problow", 1 - F.when(F.col("streak_id").isNull(), 1.0).otherwise(chance))
    rows = rows.where(F.col("Date") >= F.lit(calc_start).cast("date"))
    high = presses_too_high(paph, calc_start)
    rows = rows.join(high, [*INPUT, "Date"], "left").withColumn("toohigh", F.coalesce("toohigh", F.lit(False)))
    bad = (F.col("problow") > 0.99) | F.col("toohigh")
    return rows.select(
        *INPUT, "Date", F.dayofweek("Date").alias("DOW"), week("Date").alias("Week"), "papd", "problow",
        F.col("toohigh").cast("int").alias("probhigh"),
        F.when(bad, 0).when(~bad, 1).alias("uptime"), F.lit(1).alias("all"),
    )
