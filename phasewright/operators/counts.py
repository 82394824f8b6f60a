"""Counting, filtering and repairing detector volumes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phasewright.functions.calendar import floor_minutes, is_midweek, midnight, onto_month_start, onto_year_start
from phasewright.operators.detectors import for_volumes
from phasewright.operators.runs import run_length


@dataclass(frozen=True)
class CountLimits:
    """Limits of the detector-day filter; every comparison is strictly greater."""

    minutes: int
    volume: float
    volume_mainline: float
    mean_change: float
    mean_change_mainline: float
    flat: int
    high_periods: int


# Fixed values.
HOURLY = CountLimits(60, 1200, 3000, 200, 500, 5, 5)
QUARTER_HOURLY = CountLimits(15, 300, 750, 50, 125, 20, 20)
MAX_IMPUTED = 3000


def counts(
    events: DataFrame, config: DataFrame, *, minutes: int = 60, code: int = 82, midweek_only: bool = False
) -> DataFrame:
    """Actuations per period, signal and detector, with the called phase.

    Counting comes first and is combined before its shuffle; the join to the detector
    list then meets one row per detector and period.
    """
    rows = events.where(F.col("EventCode") == code)
    if midweek_only:
        rows = rows.where(is_midweek("Timestamp"))
    n = rows.groupBy(
        "SignalID", floor_minutes("Timestamp", minutes).alias("Timeperiod"), F.col("EventParam").alias("Detector")
    ).agg(F.count("*").cast("int").alias("vol"))
    dc = config.select("SignalID", "Detector", "CallPhase", *(["Date"] if "Date" in config.columns else []))
    if "Date" in config.columns:
        joined = n.withColumn("Date", F.to_date("Timeperiod")).join(dc, ["SignalID", "Detector", "Date"], "left")
    else:
        joined = n.join(dc, ["SignalID", "Detector"], "left")
    return joined.select("SignalID", "Timeperiod", "Detector", "CallPhase", "vol")


def _detector_grid(counted: DataFrame, config: DataFrame, minutes: int, days: DataFrame | None = None) -> DataFrame:
    """Every configured detector in every period of the days, by default those counted."""
    dc = config.select(
        "SignalID", "Detector", "CallPhase", F.col("ApproachDesc").contains("Mainline").alias("Mainline"),
        *(["Date"] if "Date" in config.columns else []),
    ).distinct()
    if days is None:
        days = counted.select(F.to_date("Timeperiod").alias("Date")).distinct()
    if "Date" in config.columns:
        daily = dc.join(days, "Date", "left_semi")
    else:
        daily = dc.withColumn("_days", days.agg(F.collect_set("Date")).scalar()).withColumn(
            "Date", F.explode("_days")
        ).drop("_days")
    start = midnight("Date")
    last = start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1440 - minutes))
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return daily.withColumn("Timeperiod", F.explode(F.sequence(start, last, step))).drop("Date")


def filter_counts(counted: DataFrame, config: DataFrame, limits: CountLimits = HOURLY, *, days: DataFrame | None = None) -> DataFrame:
    """Null the volumes of detector-days that are flat, too high or too jumpy.

    Window partitions are one detector-day, at most 96 rows; a period counted twice for the same
    detector and phase is one row with the greater volume. ``days`` (distinct ``Date``) saves a
    caller that knows them a second reading of the counts.
    """
    key = ["SignalID", "Date", "CallPhase", "Detector"]
    known = counted.where("CallPhase is not null").select("SignalID", "Timeperiod", "Detector", "CallPhase", F.col("vol").cast("double").alias("vol"))
    rows = _detector_grid(known, config, limits.minutes, days).unionByName(known, allowMissingColumns=True)
    # dealt by detector-day once: the periods are put together and all windows run where the rows then are
    rows = rows.withColumn("Date", F.to_date("Timeperiod")).repartition(*key).groupBy(*key, "Timeperiod").agg(
        F.coalesce(F.max("vol"), F.lit(0.0)).alias("vol"), F.max("Mainline").alias("Mainline"))
    ordered, whole = Window.partitionBy(*key).orderBy("Timeperiod"), Window.partitionBy(*key)
    early = F.hour("Timeperiod") < 5
    rows = rows.withColumn("delta_vol", F.col("vol") - F.lag("vol").over(ordered))
    rows = run_length(rows.withColumn("_level", F.when(early, -1.0).otherwise(F.col("vol"))), key, "Timeperiod", "_level", "_run")
    rows = rows.withColumn("flatlined", F.when(early, 0).otherwise(F.col("_run")).cast("double"))

    def over(plain, mainline):
        return F.when(F.col("Mainline"), mainline).when(~F.col("Mainline"), plain)

    high = F.count_if(F.col("vol") > limits.volume).over(whole) > limits.high_periods
    high_main = F.count_if(F.col("vol") > limits.volume_mainline).over(whole) > limits.high_periods
    mad = F.ceil(F.avg(F.abs("delta_vol")).over(whole)).cast("int")
    rows = rows.select(
        "*", mad.alias("mean_abs_delta"), F.max("flatlined").over(whole).cast("int").alias("flat_strk"),
        over(high, high_main).cast("int").alias("maxvol_flag"),
    ).withColumn("flat_flag", (F.col("flat_strk") > limits.flat).cast("int")).withColumn(
        "mad_flag",
        over(F.col("mean_abs_delta") > limits.mean_change, F.col("mean_abs_delta") > limits.mean_change_mainline).cast("int"),
    )
    failed = (F.col("flat_flag") > 0) | (F.col("maxvol_flag") > 0) | (F.col("mad_flag") > 0)
    return rows.withColumn("Good_Day", F.when(failed, 0).when(~failed, 1)).select(
        "SignalID", "Date", "Timeperiod", "Detector", "CallPhase",
        F.when(F.col("Good_Day") == 1, F.col("vol")).alias("vol"),
        "delta_vol", "mean_abs_delta", "flatlined", "flat_strk", "flat_flag", "maxvol_flag", "mad_flag", "Good_Day",
        onto_month_start("Timeperiod").alias("Month_Hour"), onto_year_start("Timeperiod").alias("Hour"),
    )


def select_count_detectors(filtered: DataFrame, config: DataFrame) -> DataFrame:
    """Filtered counts of the detectors chosen for volumes."""
    dc = for_volumes(config).where("CountPriority is not null")
    on = ["SignalID", "Detector", "CallPhase", *(["Date"] if "Date" in config.columns else [])]
    return filtered.join(dc.select(*on).distinct(), on, "left_semi")


def adjust_counts(
    filtered: DataFrame, then: Callable[[DataFrame], DataFrame] | None = None, *, max_imputed: float = MAX_IMPUTED
) -> DataFrame:
    """Impute missing volumes from sibling detectors, then from the month's median.

    Rows are dealt by signal, phase and month once. Everything is a window inside such a month, the shares of
    its detectors among them, so no other exchange follows; a month of one phase is what its detectors count.
    """
    dealt = ["SignalID", "CallPhase", "_month"]
    month, by_detector = Window.partitionBy(*dealt), Window.partitionBy(*dealt, "Detector")
    phase_period = Window.partitionBy(*dealt, "Timeperiod")
    fc = filtered.select(
        "SignalID", "CallPhase", "Detector", "Timeperiod", "Month_Hour", F.col("vol").cast("double").alias("vol"),
        F.dayofweek("Timeperiod").alias("DOW"), F.trunc("Timeperiod", "month").alias("_month"),
    ).repartition(*dealt)
    # shares come from the periods in which no detector of the phase is missing
    fc = fc.withColumn("_v", F.when(F.count_if(F.col("vol").isNull()).over(phase_period) == 0, F.col("vol")))
    share = F.try_divide(F.sum("_v").over(by_detector), F.sum("_v").over(month))
    rows = fc.withColumn("_share", share)
    unbounded = F.bool_or((F.col("_share") == 0) & (F.col("vol") > 0)).over(phase_period)
    implied = F.avg(F.try_divide("vol", "_share")).over(phase_period)
    rows = rows.select("*", F.when(F.coalesce(unbounded, F.lit(False)), None).otherwise(implied).alias("_phase_vol"))
    sibling = F.when(F.col("_phase_vol") <= max_imputed, F.floor(F.col("_phase_vol") * F.col("_share")).cast("double"))
    rows = rows.withColumn("vol", F.coalesce(F.col("vol"), sibling))
    usual = F.median("vol").over(Window.partitionBy(*dealt, "Detector", "DOW", "Month_Hour"))
    out = rows.withColumn("_usual", usual).select(
        "SignalID", "CallPhase", "Detector", "Timeperiod", F.floor(F.coalesce("vol", "_usual")).cast("int").alias("vol")
    ).where("vol is not null")
    out = out.withColumn("Date", F.to_date("Timeperiod"))
    return then(out) if then else out
