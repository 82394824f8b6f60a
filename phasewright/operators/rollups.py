"""Rollups from signal to corridor and zone group, by period, with change.

Every function takes the measure column and, where it has one, its weight column; a
weight of None counts rows. Frames here are already one row per entity and period, so
windows over an entity are as long as the report.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasewright.functions.calendar import (
    AM_PEAK_HOURS,
    PM_PEAK_HOURS,
    floor_hour,
    floor_minutes,
    is_midweek,
    is_peak,
    month_of,
    onto_date,
    onto_month_start,
    quarter_of,
    tuesday_of_week,
    week,
)
from phasewright.functions.stats import sum0, wmean, with_delta
from phasewright.operators.runs import complete_dates, complete_ints

ONES = "ones"
CORRIDOR = ["Zone_Group", "Zone", "Corridor"]


def _weighted(df: DataFrame, wt: str | None) -> tuple[DataFrame, str]:
    if wt is None or wt == ONES:
        return (df if ONES in df.columns and wt == ONES else df.withColumn(ONES, F.lit(1))), ONES
    return df, wt


# Corridors and zone groups ------------------------------------------------------------------


def by_corridor(
    df: DataFrame, corridors: DataFrame, period: str, var: str, wt: str | None = None, *, on: tuple[str, ...] = ("SignalID",)
) -> DataFrame:
    """Mean of the signals of each corridor and period, with change.

    Only the hierarchy columns are joined; rows outside it drop. ``on`` is the corridor
    columns for frames already at that level (they then meet one row per signal).
    """
    drop = [c for c in CORRIDOR if c in df.columns and c not in on]
    hierarchy = corridors.select(*dict.fromkeys([*on, *CORRIDOR])).where("Corridor is not null")
    rows = df.drop(*drop).join(hierarchy, [*on])
    key = [*CORRIDOR, period]
    if wt is None:
        out = rows.groupBy(*key).agg(F.avg(var).alias(var))
    else:
        out = rows.groupBy(*key).agg(wmean(var, wt).alias(var), sum0(wt).alias(wt))
    return with_delta(out, var, CORRIDOR, period)


def zone_group_rows(df: DataFrame, period: str, var: str, wt: str) -> DataFrame:
    """One row per zone group and period, named by its group."""
    out = df.groupBy("Zone_Group", period).agg(wmean(var, wt).alias(var), sum0(wt).alias(wt))
    out = with_delta(out, var, ["Zone_Group"], period)
    return out.select("Zone_Group", F.col("Zone_Group").alias("Corridor"), period, var, wt, "delta")


def zone_group_sums(df: DataFrame, period: str, var: str) -> DataFrame:
    """As the weighted zone-group rows, but summed."""
    out = with_delta(df.groupBy("Zone_Group", period).agg(sum0(var).alias(var)), var, ["Zone_Group"], period)
    return out.select("Zone_Group", F.col("Zone_Group").alias("Corridor"), period, var, "delta")


def with_zone_groups(cor: DataFrame, period: str, var: str, wt: str) -> DataFrame:
    """Corridor rows under their zone, together with the zone-group rows."""
    rows = cor.select(F.col("Zone").alias("Zone_Group"), "Corridor", period, var, wt, "delta")
    return rows.unionByName(zone_group_rows(cor, period, var, wt)).distinct()


def corridor_rollup(
    df: DataFrame, corridors: DataFrame, var: str, wt: str | None = None, *, period: str,
    keep_missing: bool = False, on: tuple[str, ...] = ("SignalID",),
) -> DataFrame:
    """Corridor and zone-group rows of a measure on a period column."""
    df, wt = _weighted(df, wt)
    cor = by_corridor(df, corridors, period, var, wt, on=on)
    if not keep_missing:
        cor = cor.where(F.col(var).isNotNull())
    return with_zone_groups(cor, period, var, wt)


def corridor_by_date(df: DataFrame, corridors: DataFrame, var: str, wt: str | None = None, *, period: str = "Date", **kw) -> DataFrame:
    """Corridor rows on a date, with its week."""
    return corridor_rollup(df, corridors, var, wt, period=period, **kw).withColumn("Week", week(period))


def corridor_by_month(df: DataFrame, corridors: DataFrame, var: str, wt: str | None = None, **kw) -> DataFrame:
    return corridor_rollup(df, corridors, var, wt, period="Month", **kw)


def corridor_by_hour(df: DataFrame, corridors: DataFrame, var: str, wt: str | None = None, **kw) -> DataFrame:
    return corridor_rollup(df, corridors, var, wt, period="Hour", keep_missing=True, **kw)


# Signals by period --------------------------------------------------------------------------


def hourly(df: DataFrame, var: str, corridors: DataFrame) -> DataFrame:
    """Hours of each mapped signal with change; signals without data keep one empty row."""
    rows = corridors.select("SignalID", *CORRIDOR, "Subcorridor").where("Corridor is not null").join(df, "SignalID", "left")
    return with_delta(rows, var, ["SignalID"], "Hour").select("SignalID", "Hour", var, "delta", *CORRIDOR, "Subcorridor")


def period_avg(df: DataFrame, var: str, period: str, wt: str | None = None) -> DataFrame:
    df, wt = _weighted(df, wt)
    out = df.groupBy("SignalID", period).agg(wmean(var, wt).alias(var), sum0(wt).alias(wt))
    return with_delta(out, var, ["SignalID"], period)


def period_sum(df: DataFrame, var: str, period: str) -> DataFrame:
    return with_delta(df.groupBy("SignalID", period).agg(sum0(var).alias(var)), var, ["SignalID"], period)


def daily_avg(df: DataFrame, var: str, wt: str | None = None, *, peak_only: bool = False) -> DataFrame:
    """Weighted mean by signal and day (A08); on peak hours of arrivals on green it is A09."""
    rows = df.where(is_peak("Date_Hour")) if peak_only else df
    return period_avg(rows, var, "Date", wt)


def daily_aog(aog: DataFrame) -> DataFrame:
    return daily_avg(aog, "aog", "vol", peak_only=True)


def daily_sum(df: DataFrame, var: str) -> DataFrame:
    """Daily sums with change; days without rows appear as 0 and without change."""
    out = complete_dates(period_sum(df, var, "Date"), ["SignalID"], "Date")
    return out.select("SignalID", "Date", F.coalesce(var, F.lit(0)).alias(var), "delta")


def sum_by_period(df: DataFrame, var: str, *, minutes: int = 60) -> DataFrame:
    """Sums by signal, phase and period; change within signal, phase, week and weekday."""
    per = df.groupBy("SignalID", "CallPhase", floor_minutes("Timeperiod", minutes).alias("Timeperiod")).agg(sum0(var).alias(var))
    per = per.withColumn("Week", week(F.to_date("Timeperiod"))).withColumn("DOW", F.dayofweek("Timeperiod"))
    return with_delta(per, var, ["SignalID", "CallPhase", "Week", "DOW"], "Timeperiod")


def volume_per_period(counts: DataFrame, *, minutes: int = 60, phases: tuple[int, ...] | None = (2, 6)) -> DataFrame:
    """Volume by signal and period over the phases (A10)."""
    rows = counts if phases is None else counts.where(F.col("CallPhase").isin(*phases))
    name = "Hour" if minutes == 60 else "Timeperiod"
    per = rows.groupBy("SignalID", floor_minutes("Timeperiod", minutes).alias(name)).agg(sum0("vol").alias("vph"))
    return per.withColumn("Week", week(F.to_date(name))).withColumn("DOW", F.dayofweek(name))


def _with_tuesday(df: DataFrame, dates: DataFrame, day: str = "Date") -> DataFrame:
    """Date of each week: its Tuesday, not before the first date of the data."""
    first = dates.agg(F.min(day)).scalar()
    return df.withColumn("Date", tuesday_of_week("Week", first))


def weekly_sum(df: DataFrame, var: str) -> DataFrame:
    """Mean over the days of a week by phase, summed over phases."""
    phase = df.groupBy("SignalID", "Week", "CallPhase").agg(F.avg(var).alias(var))
    out = with_delta(phase.groupBy("SignalID", "Week").agg(sum0(var).alias(var)), var, ["SignalID"], "Week")
    return _with_tuesday(out, df).select("SignalID", "Date", "Week", var, "delta")


def weekly_avg(df: DataFrame, var: str, wt: str | None = None, *, peak_only: bool = True) -> DataFrame:
    """Weighted mean of a week by phase, then over phases; missing weeks appear empty."""
    df, wt = _weighted(df, wt)
    rows = df.where(is_peak("Date_Hour")) if peak_only else df
    phase = rows.groupBy("SignalID", "CallPhase", "Week").agg(wmean(var, wt).alias(var), sum0(wt).alias(wt))
    phase = complete_ints(phase, ["SignalID", "CallPhase"], "Week")
    out = phase.groupBy("SignalID", "Week").agg(wmean(var, wt).alias(var), sum0(wt).alias(wt))
    return _with_tuesday(with_delta(out, var, ["SignalID"], "Week"), df).select("SignalID", "Date", "Week", var, wt, "delta")


def monthly_avg(df: DataFrame, var: str, wt: str | None = None, *, peak_only: bool = False) -> DataFrame:
    """Monthly value of each signal.

    Without a weight the days are averaged by phase and the phases summed; with one,
    both steps are weighted means. Missing months appear empty.
    """
    rows = df.where(is_peak("Date_Hour")) if peak_only else df
    if wt is not None:
        rows, wt = _weighted(rows, wt)
    rows = rows.withColumn("Month", month_of("Date"))
    by_phase = rows.groupBy("SignalID", "CallPhase", "Month")
    phase = by_phase.agg(F.avg(var).alias(var)) if wt is None else by_phase.agg(wmean(var, wt).alias(var), sum0(wt).alias(wt))
    phase = complete_dates(phase, ["SignalID", "CallPhase"], "Month", step="interval 1 month")
    by_signal = phase.groupBy("SignalID", "Month")
    out = by_signal.agg(sum0(var).alias(var)) if wt is None else by_signal.agg(wmean(var, wt).alias(var), sum0(wt).alias(wt))
    return with_delta(out, var, ["SignalID"], "Month")


def weekly_by_hour(df: DataFrame, var: str, wt: str | None = None) -> DataFrame:
    """Hours of a week laid onto its Tuesday, mean by phase then over phases."""
    rows = df if "CallPhase" in df.columns else df.withColumn("CallPhase", F.lit(0))
    dated = rows.withColumn("_day", F.to_date("Hour"))
    tue = _with_tuesday(dated.drop("Date"), dated, "_day").withColumn("Hour", onto_date("Hour", "Date"))
    key = ["SignalID", "Week", "Hour"]
    by_phase = tue.groupBy(*key, "CallPhase")
    phase = by_phase.agg(F.avg(var).alias(var)) if wt is None else by_phase.agg(wmean(var, wt).alias(var), sum0(wt).alias(wt))
    by_signal = phase.groupBy(*key)
    out = by_signal.agg(F.avg(var).alias(var)) if wt is None else by_signal.agg(wmean(var, wt).alias(var), sum0(wt).alias(wt))
    # The change runs within the signal's week, hour after hour.
    return with_delta(out, var, ["SignalID", "Week"], "Hour")


def avg_by_hour(df: DataFrame, var: str, wt: str | None = None) -> DataFrame:
    """Weighted mean by signal, phase and hour; change within signal and phase."""
    df, wt = _weighted(df, wt)
    out = df.groupBy("SignalID", "CallPhase", floor_hour("Date_Hour").alias("Hour")).agg(wmean(var, wt).alias(var), sum0(wt).alias(wt))
    out = out.withColumn("Week", week(F.to_date("Hour"))).withColumn("DOW", F.dayofweek("Hour"))
    return with_delta(out, var, ["SignalID", "CallPhase"], "Hour")


def monthly_by_hour(df: DataFrame, var: str, wt: str | None = None, *, change: bool = True) -> DataFrame:
    """Signal-hours averaged, then laid onto the first of the month and averaged again."""
    df, wt = _weighted(df, wt)
    hours = df.groupBy("SignalID", "Hour").agg(wmean(var, wt).alias(var), sum0(wt).alias(wt))
    month = hours.groupBy("SignalID", onto_month_start("Hour").alias("Hour")).agg(wmean(var, wt).alias(var), sum0(wt).alias(wt))
    return with_delta(month, var, ["SignalID"], "Hour") if change else month


def monthly_volume_by_hour(df: DataFrame, var: str = "vph") -> DataFrame:
    """Tuesday to Thursday volumes summed per hour, averaged onto the month's hour."""
    hours = df.where(is_midweek("Hour")).groupBy("SignalID", "Hour").agg(sum0(var).alias(var))
    return hours.groupBy("SignalID", onto_month_start("Hour").alias("Hour")).agg(F.avg(var).alias(var))


def monthly_flash_events(flash: DataFrame) -> DataFrame:
    """Flash events per signal and month."""
    n = flash.groupBy("SignalID", month_of("Date").alias("Date")).agg(F.count("*").alias("flash"))
    return monthly_avg(n.withColumn("CallPhase", F.lit(0)), "flash")


def _period_of_day(ts: str):
    hour = F.hour(ts)
    return F.when(hour.isin(*AM_PEAK_HOURS), "am").when(hour.isin(*PM_PEAK_HOURS), "pm")


def volume_at_peaks(df: DataFrame, var: str = "vph", period: str = "Month") -> DataFrame:
    """Morning and evening means per signal and period, told apart by a column."""
    rows = df.withColumn("period_of_day", _period_of_day("Hour")).where("period_of_day is not null")
    out = rows.groupBy("SignalID", "period_of_day", F.to_date("Hour").alias(period)).agg(F.avg(var).alias(var), F.count("*").alias(ONES))
    return with_delta(out, var, ["SignalID", "period_of_day"], period)


def corridor_at_peaks(cor: DataFrame, var: str = "vph", wt: str | None = None, period: str = "Month") -> DataFrame:
    """Morning and evening means per corridor and period."""
    rows = cor.withColumn("period_of_day", _period_of_day("Hour")).where("period_of_day is not null")
    level = [c for c in CORRIDOR if c in cor.columns]
    group = rows.groupBy(*level, "period_of_day", F.to_date("Hour").alias(period))
    out = group.agg(F.avg(var).alias(var)) if wt is None else group.agg(wmean(var, wt).alias(var), sum0(wt).alias(wt))
    return with_delta(out, var, [*level, "period_of_day"], period)


def quarterly(monthly: DataFrame, var: str, wt: str | None = None, operation: str = "avg") -> DataFrame:
    """Quarters of a corridor's months: weighted mean, sum or the latest month (A26); the weight is ``ones``, 1 where that is absent."""
    rows, wt = _weighted(monthly, wt or ONES)
    rows = rows.withColumn("Quarter", quarter_of("Month"))
    key = ["Corridor", "Zone_Group", "Quarter"]
    if operation == "avg":
        out = rows.groupBy(*key).agg(wmean(var, wt).alias(var), sum0(wt).alias(wt))
    elif operation == "sum":
        out = rows.groupBy(*key).agg(sum0(var).alias(var))
    elif operation == "latest":
        out = rows.groupBy(*key).agg(F.max_by(F.struct(F.col(var), F.col(wt)), "Month").alias("_r")).select(*key, "_r.*")
    else:
        raise ValueError(f"unknown operation {operation!r}")
    return with_delta(out, var, ["Corridor", "Zone_Group"], "Quarter")


def signal_rows(df: DataFrame, cor: DataFrame, corridors: DataFrame, identifier: str = "SignalID") -> DataFrame:
    """Signals shown as the corridors of their corridor, with the corridor rows themselves.

    Cameras (``identifier="CameraID"``) are named by corridor and id, as an id may stand at several
    corridors; their rows then bring their corridor, and their name is the ``Location``.
    """
    camera = identifier != "SignalID"
    on = ["Corridor", identifier] if camera else [identifier]
    names = (F.min("Location"), F.min("Location")) if camera else (F.min("Description"), F.min("Name"))
    named = corridors.groupBy(identifier, "Corridor").agg(names[0].alias("Description"), names[1].alias("Name"))
    if camera:
        named = named.withColumn("Description", F.lit(None).cast("string"))
    drop = [c for c in ("Corridor", "Zone_Group", "Zone", "Subcorridor") if c in df.columns and c not in on]
    rows = df.drop(*drop).join(named, on, "left").select(
        F.col("Corridor").alias("Zone_Group"), F.col(identifier).alias("Corridor"),
        F.coalesce("Description", F.col(identifier)).alias("Description"), "Name",
        *[c for c in df.columns if c not in (*on, *drop)],
    )
    shown = df.select(*on).distinct().join(named, on).select("Corridor").distinct()
    totals = cor.join(shown, "Corridor", "left_semi").drop("Zone_Group", "Subcorridor", "Zone").withColumn(
        "Zone_Group", F.col("Corridor")
    ).withColumn("Description", F.col("Corridor"))
    return rows.unionByName(totals, allowMissingColumns=True)


# Detector uptime ----------------------------------------------------------------------------


def daily_detector_uptime(filtered: DataFrame) -> DataFrame:
    """Share of good detectors per phase and period, periods without any volume left out."""
    silent = filtered.groupBy("SignalID", "Timeperiod").agg(sum0("vol").alias("_v")).where("_v = 0")
    rows = filtered.join(silent, ["SignalID", "Timeperiod"], "left_anti")
    setback = F.when(F.col("CallPhase").isin(2, 6), "Setback").otherwise("Presence")
    return (
        rows.groupBy("SignalID", "CallPhase", "Date", F.col("Timeperiod").alias("Date_Hour"), setback.alias("setback"))
        .agg(sum0("Good_Day").alias("_good"), F.count("*").cast("double").alias("all"))
        .withColumn("uptime", F.col("_good") / F.col("all")).drop("_good")
    )


def avg_daily_detector_uptime(ddu: DataFrame) -> DataFrame:
    """Setback, presence and overall uptime of a signal's day in one pass."""

    def part(kind: str | None, suffix: str):
        here = F.lit(True) if kind is None else F.col("setback") == kind
        u, n = F.when(here, F.col("uptime")), F.when(here, F.col("all"))
        return [wmean(u, n).alias(f"uptime{suffix}"), F.sum(n).alias(f"all{suffix}")]

    out = ddu.groupBy("SignalID", "Date").agg(*part(None, ""), *part("Setback", "_sb"), *part("Presence", "_pr"))
    return with_delta(out, "uptime", ["SignalID"], "Date")


def _three_uptimes(avg: DataFrame, corridors: DataFrame, period: str, weighted: bool) -> DataFrame:
    """Corridor uptimes of the three kinds side by side; setback or presence decides which rows appear."""
    key = ["Zone_Group", "Corridor", period]

    def part(var: str, wt: str | None):
        out = corridor_rollup(avg.where(F.col(var).isNotNull()), corridors, var, wt, period=period)
        return out.select(*key, var, *(["delta"] if var == "uptime" and weighted else []))

    both = part("uptime_sb", "all_sb").join(part("uptime_pr", "all_pr"), key, "full_outer")
    return both.join(part("uptime", "all" if weighted else None), key, "left")


def corridor_daily_detector_uptime(avg: DataFrame, corridors: DataFrame) -> DataFrame:
    """Corridor uptime by day; overall treats all signals alike."""
    return _three_uptimes(avg, corridors, "Date", weighted=False).withColumn("Week", week("Date"))


def corridor_monthly_detector_uptime(avg: DataFrame, corridors: DataFrame) -> DataFrame:
    """Corridor uptime by month, overall weighted by detectors."""
    return _three_uptimes(avg.withColumn("Month", month_of("Date")), corridors, "Month", weighted=True)


# Descriptor-driven --------------------------------------------------------------------------


def aggregate_plans(metric, daily: DataFrame, corridors: DataFrame, subcorridors: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    """All levels and periods of a measure as functions, keyed ``{level}_{period}_{table}``.

    ``daily`` should be a stored table: every result is planned from it on its own.
    """
    var, wt, peak_only = metric.variable, metric.weight, metric.peak_only
    signals = {
        "dy": (lambda: daily, "Date"),
        "wk": (cache(lambda: weekly_avg(daily, var, wt, peak_only=peak_only)), "Date"),
        "mo": (cache(lambda: monthly_avg(daily, var, wt or ONES, peak_only=peak_only)), "Month"),
    }
    plans: dict[str, Callable[[], DataFrame]] = {}

    def level(hierarchy, frame, period):
        return (corridor_by_date if period == "Date" else corridor_by_month)(frame(), hierarchy, var, wt)

    def signal(frame, cor, period):
        rows = frame()
        rows = rows if "delta" in rows.columns else rows.withColumn("delta", F.lit(None).cast("double"))
        return signal_rows(rows, cor(), corridors).select("Zone_Group", "Corridor", period, var, "delta").where("Zone_Group is not null")

    for per, (frame, period) in signals.items():
        cor = cache(partial(level, corridors, frame, period))
        plans[f"cor_{per}_{metric.table}"] = cor
        plans[f"sub_{per}_{metric.table}"] = partial(level, subcorridors, frame, period)
        plans[f"sig_{per}_{metric.table}"] = partial(signal, frame, cor, period)
    for name in ("sig", "sub", "cor"):
        plans[f"{name}_qu_{metric.table}"] = lambda n=name: quarterly(plans[f"{n}_mo_{metric.table}"](), var)
    return plans


def aggregate(metric, daily: DataFrame, corridors: DataFrame, subcorridors: DataFrame) -> dict[str, DataFrame]:
    """All levels and periods of a measure at once."""
    return {name: plan() for name, plan in aggregate_plans(metric, daily, corridors, subcorridors).items()}
