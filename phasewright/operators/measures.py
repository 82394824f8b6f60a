"""Daily and period measures from events, cycles, detections and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasewright.functions.calendar import (
    floor_minutes,
    is_midweek,
    is_peak,
    micros,
    midnight,
    month_of,
    plus_seconds,
    seconds_between,
    week,
)
from phasewright.functions.sketches import merged, quantile, seen, sketch
from phasewright.functions.stats import sum0, wmean
from phasewright.operators.carry import LAST, Mark, asof, carry
from phasewright.operators.runs import complete_dates


def _calendar(df: DataFrame, day: str = "Date") -> DataFrame:
    return df.withColumn("DOW", F.dayofweek(day)).withColumn("Week", week(day))


# Uptime -------------------------------------------------------------------------------------


def _uptime(minutes: DataFrame, keys: list[str]) -> DataFrame:
    """Share of the day without gaps over 15 minutes; a partition is one day of minutes."""
    w = Window.partitionBy(*keys).orderBy("at")
    gap = seconds_between(F.lag("at").over(w), F.col("at")) / 60
    return minutes.withColumn("_gap", gap).groupBy(*keys).agg(
        (1 - F.sum(F.when(F.col("_gap") > 15, F.col("_gap")).otherwise(0.0)) / 1440).alias("uptime")
    )


def uptime(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Communication uptime per signal and day, and of the whole system per day."""
    seen = events.select("SignalID", "Date", floor_minutes("Timestamp", 1).alias("at")).distinct()
    start = midnight("Date")
    end = plus_seconds(start, F.lit(86399.9))
    bookends = seen.select("SignalID", "Date").distinct().withColumn("at", F.explode(F.array(start, end)))
    per_signal = seen.unionByName(bookends).distinct()
    system = per_signal.select("Date", "at").distinct()
    return _uptime(per_signal, ["SignalID", "Date"]), _uptime(system, ["Date"]).withColumnRenamed("uptime", "uptime_all")


def comm_uptime(events: DataFrame) -> DataFrame:
    """Signal uptime with the time the whole system was silent given back."""
    signal, system = uptime(events)
    return _calendar(
        signal.join(system, "Date", "left").select(
            "SignalID", F.lit(0).alias("CallPhase"), "Date", midnight("Date").alias("Date_Hour"),
            (F.col("uptime") + (1 - F.col("uptime_all"))).alias("uptime"),
        )
    )


def detector_uptime(filtered: DataFrame) -> DataFrame:
    """Good_Day of every detector on every date of the data, null where absent."""
    days = filtered.select("Date", "SignalID", "Detector", "Good_Day").distinct()
    return complete_dates(days, ["SignalID", "Detector"], "Date")


def bad_detectors(filtered: DataFrame) -> DataFrame:
    return detector_uptime(filtered).where("Good_Day = 0")


def bad_ped_inputs(ped_uptime: DataFrame) -> DataFrame:
    return ped_uptime.where("uptime = 0").select("SignalID", "Detector", "Date")


def comm_quality_uptime(quality: DataFrame, corridors: DataFrame) -> DataFrame:
    """Quality readings of their own date, after the signal came into use."""
    since = corridors.groupBy("SignalID").agg(F.min("Asof").alias("Asof"))
    rows = quality.where(F.col("CSDATE") == F.col("Date")).withColumnRenamed("AssetNum", "SignalID").join(since, "SignalID")
    return _calendar(
        rows.where(F.col("Date") >= F.col("Asof")).select(
            "SignalID", F.lit(0).alias("CallPhase"), "Date", (F.col("AvgQuality") / 100).alias("uptime")
        )
    )


# Volumes ------------------------------------------------------------------------------------


def volume_per_day(counts: DataFrame, *, phases: tuple[int, ...] | None = (2, 6)) -> DataFrame:
    """Daily volume by signal and phase; also daily pedestrian presses with all phases."""
    rows = counts if phases is None else counts.where(F.col("CallPhase").isin(*phases))
    return _calendar(
        rows.groupBy("SignalID", "CallPhase", F.to_date("Timeperiod").alias("Date")).agg(sum0("vol").alias("vpd"))
    )


def throughput(counts_15min: DataFrame) -> DataFrame:
    """95th percentile of the day's quarter-hour volumes, as vehicles per hour."""
    per = counts_15min.groupBy("SignalID", "Timeperiod").agg(sum0("vol").alias("_v"))
    day = per.groupBy("SignalID", F.to_date("Timeperiod").alias("Date")).agg(
        (F.percentile("_v", 0.95) * 4).alias("vph")
    )
    return _calendar(day.withColumn("CallPhase", F.lit(0)))


def throughput_sketches(counts_15min: DataFrame) -> DataFrame:
    """A sketch of each signal's quarter-hour volumes by day (M07 for periods longer than a day)."""
    per = counts_15min.groupBy("SignalID", "Timeperiod").agg(F.sum("vol").cast("double").alias("vol"))
    return per.groupBy("SignalID", F.to_date("Timeperiod").alias("Date")).agg(sketch("vol").alias("sketch"))


def throughput_from_sketches(sketches: DataFrame, period: Column) -> DataFrame:
    """95th percentile of the quarter-hours of a period as vehicles per hour, of stored sketches: ``SignalID``, ``Period``, ``vph``, ``n``."""
    out = sketches.groupBy("SignalID", period.alias("Period")).agg(merged("sketch").alias("sketch"))
    return out.select("SignalID", "Period", (quantile("sketch", 0.95) * 4).alias("vph"), seen("sketch").alias("n"))


def actuation_sketches(detections: DataFrame, config: DataFrame) -> DataFrame:
    """A sketch of the actuations of each spillback detector by day (M14 for periods longer than a cycle)."""
    dc = config.select("SignalID", F.col("CallPhase").alias("Phase"), "Detector", *(["Date"] if "Date" in config.columns else [])).distinct()
    rows = detections.join(dc, [c for c in dc.columns], "left_semi")
    return rows.groupBy("SignalID", "Phase", "Detector", "Date").agg(sketch("DetDuration").alias("sketch"))


def ped_count_repair(papd: DataFrame, bad: DataFrame) -> DataFrame:
    """Counts of bad days replaced by the month's mean of the input's good days."""
    keys = ["SignalID", "Detector", "CallPhase"]
    marked = papd.join(
        bad.select("SignalID", "Detector", "Date", F.lit(True).alias("_bad")).distinct(), ["SignalID", "Detector", "Date"], "left"
    )
    good = F.when(F.col("_bad").isNull(), F.col("papd"))
    usual = F.floor(F.avg(good).over(Window.partitionBy(*keys, month_of("Date"))))
    return marked.withColumn("papd", F.when(F.col("_bad"), usual).otherwise(F.col("papd"))).drop("_bad")


# Arrivals on green --------------------------------------------------------------------------


def arrivals_on_green(detections: DataFrame, config: DataFrame, *, minutes: int = 60) -> DataFrame:
    """Arrivals on green, green ratio and progression ratio by period, signal and phase.

    The green ratio is built from the intervals that had arrivals; a period starts in
    the interval in force, and the day's last interval has no end.
    """
    advanced = config.where(F.col("DetectionTypeDesc").contains("Advanced Count")).select("SignalID", "Detector")
    de = detections.distinct().join(advanced.distinct(), ["SignalID", "Detector"], "left_semi")
    by = ["SignalID", "Phase", "Date"]
    green = F.col("EventCode") == 1
    arrivals = de.groupBy(*by, floor_minutes("DetTimeStamp", minutes).alias("Hour")).agg(
        F.count_if(green).alias("Green_Arrivals"), F.count("*").alias("All_Arrivals")
    ).where("Green_Arrivals > 0").withColumn("AOG", F.col("Green_Arrivals") / F.col("All_Arrivals"))

    intervals = de.select(*by, F.col("PhaseStart").alias("at"), F.col("EventCode").alias("code")).distinct()
    starts = F.sequence(
        midnight("Date"), midnight("Date") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1440 - minutes)),
        F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes)),
    )
    bounds = de.select(*by).distinct().withColumn("at", F.explode(starts)).withColumn("code", F.lit(None).cast("int"))
    line = carry(
        intervals.unionByName(bounds), by, "at", [Mark("_in_force", F.col("code").isNotNull(), F.col("code"))],
        source=intervals, rank=F.coalesce(F.col("code"), F.lit(LAST)),
    ).withColumn("Hour", floor_minutes("at", minutes))
    inside = Window.partitionBy(*by, "Hour").orderBy("at", F.col("code").asc_nulls_last())
    period_end = F.col("Hour") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    end = F.coalesce(F.lead("at").over(inside), F.when(F.to_date(period_end) == F.col("Date"), period_end))
    spans = line.withColumn("_s", F.coalesce(seconds_between(F.col("at"), end), F.lit(0.0)))
    ratio = spans.where("_in_force is not null").groupBy(*by, "Hour").agg(
        F.sum(F.when(F.col("_in_force") == 1, F.col("_s")).otherwise(0.0)).alias("Green_Duration"),
        F.sum("_s").alias("Duration"),
        F.bool_or(F.col("_in_force") == 1).alias("_any"),
    ).where("_any").drop("_any").withColumn("gC", F.try_divide("Green_Duration", "Duration"))
    return arrivals.join(ratio, [*by, "Hour"], "left").withColumn("pr", F.try_divide("AOG", "gC"))


def shape_aog(aog: DataFrame) -> DataFrame:
    """Arrivals on green in the column names of the measure tables."""
    return _calendar(
        aog.select(
            "SignalID", F.col("Phase").alias("CallPhase"), "Date", F.col("Hour").alias("Date_Hour"),
            F.col("AOG").alias("aog"), "pr", F.col("All_Arrivals").alias("vol"),
        )
    )


def daily_aog_by_phase(aog: DataFrame) -> DataFrame:
    """Peak hours of Tuesday to Thursday by phase (M08); the daily rollup supersedes it."""
    rows = aog.where(is_midweek("Date") & is_peak("Date_Hour"))
    return _calendar(
        rows.groupBy("SignalID", "CallPhase", "Date").agg(wmean("aog", "vol").alias("aog"), sum0("vol").alias("vol"))
    )


def daily_progression(aog: DataFrame) -> DataFrame:
    """Progression ratio by signal, phase and day."""
    return _calendar(
        aog.groupBy("SignalID", "CallPhase", "Date").agg(wmean("pr", "vol").alias("pr"), sum0("vol").alias("vol"))
    )


# Split failures -----------------------------------------------------------------------------


def occupancy(
    detections: DataFrame, intervals: DataFrame, *, by: tuple[str, ...] = ("CycleStart",), merge_spans: bool = False, bin_seconds: int = 3600
) -> DataFrame:
    """Greatest detector occupancy of each interval's cycle, 0 where nothing was detected (M10): covered time by the longest interval that the detector meets.

    ``detections`` has SignalID, Phase, Date, Detector, DetOn, DetOff; ``intervals`` has
    SignalID, Phase, Date, IntervalStart, IntervalEnd and the columns ``by``, which tell cycles apart.

    A sweep over on and off edges: the time covered before an instant t is the sum of n * (t - edge)
    over the edges up to t, n being 1 for on and -1 for off. Each interval asks for it at its two ends,
    so rows are as many as edges and interval ends, however long a detector stays on. Running sums work
    inside bins of the day, and what earlier bins add up to comes from one row for each bin. Spans of
    a detector that overlap count twice, unless ``merge_spans`` joins them first.
    """
    keys = ["SignalID", "Phase", "Date"]
    at = lambda c: micros(c) - micros(midnight("Date"))
    named = F.col("Detector").cast("string").alias("_det")
    spans = detections.where("DetOn <= DetOff").select(*keys, named, at("DetOn").alias("_on"), at("DetOff").alias("_off"))
    if merge_spans:
        spans = _merged_spans(spans, [*keys, "_det"])
    edge = lambda c, n: F.struct(F.col(c).alias("_t"), F.lit(n).alias("_n"))
    edges = spans.select(*keys, "_det", F.explode(F.array(edge("_on", 1), edge("_off", -1))).alias("_e")).select(*keys, "_det", "_e.*")
    end = lambda c, sign: F.struct(at(c).alias("_t"), F.lit(sign).alias("_sign"))
    valid = F.col("IntervalStart") <= F.col("IntervalEnd")
    asked = intervals.join(spans.select(*keys, "_det").distinct(), keys, "left").select(
        *keys, F.coalesce("_det", F.lit("")).alias("_det"), *by, F.when(valid, seconds_between("IntervalStart", "IntervalEnd")).alias("_span"),
        at("IntervalStart").alias("_start"), F.explode(F.array(end("IntervalStart", -1), end("IntervalEnd", 1))).alias("_e"), valid.alias("_valid"))
    asked = asked.select(*keys, "_det", *by, "_span", "_start", "_valid", "_e.*")
    rows = edges.unionByName(asked, allowMissingColumns=True).withColumns({
        "_bin": F.floor(F.col("_t") / (bin_seconds * 1_000_000)), "_n": F.coalesce("_n", F.lit(0)), "_nt": F.coalesce(F.col("_n") * F.col("_t"), F.lit(0)),
        "_on": F.coalesce(F.col("_n") == 1, F.lit(False)).cast("int"), "_off": F.coalesce(F.col("_n") == -1, F.lit(False)).cast("int")})
    place = [*keys, "_det", "_bin"]
    order = Window.partitionBy(*place).orderBy("_t")
    until, before = (order.rangeBetween(Window.unboundedPreceding, last) for last in (Window.currentRow, -1))
    # ons up to an interval's end less offs before its start are the spans that meet it
    seen = F.when(F.col("_sign") == 1, F.sum("_on").over(until)).otherwise(-F.sum("_off").over(before))
    local = rows.withColumns({"_count": F.sum("_n").over(until), "_total": F.sum("_nt").over(until), "_seen": F.coalesce(seen, F.lit(0))})
    local = local.where("_sign IS NOT NULL").drop("_n", "_nt", "_on", "_off")
    earlier = Window.partitionBy(*keys, "_det").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    added = ("_n", "_nt", "_on", "_off")
    bins = rows.groupBy(*place).agg(*[F.sum(c).alias(c) for c in added])
    bins = bins.select(*place, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}0") for c in added])
    # by cycle once: intervals, detectors and cycles are aggregated where the rows then are
    met = local.join(bins, place).repartition(*keys, *by)
    covered = F.col("_t") * (F.col("_count") + F.col("_n0")) - (F.col("_total") + F.col("_nt0"))
    spans_met = F.col("_seen") + F.when(F.col("_sign") == 1, F.col("_on0")).otherwise(-F.col("_off0"))
    per_interval = met.groupBy(*keys, *by, "_det", "_span", "_start").agg(
        F.sum(F.when(F.col("_valid"), F.col("_sign") * covered)).alias("_covered"), F.when(F.sum(spans_met) > 0, F.col("_span")).alias("_met"))
    per_detector = per_interval.groupBy(*keys, *by, "_det").agg(F.try_divide(F.sum("_covered") / F.lit(1e6), F.max("_met")).alias("occ"))
    return per_detector.groupBy(*keys, *by).agg(F.coalesce(F.max("occ"), F.lit(0.0)).alias("occ"))


def _merged_spans(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Spans ``_on``, ``_off`` of each key with those that touch or overlap made one."""
    order = Window.partitionBy(*keys).orderBy("_on", "_off")
    before = F.max("_off").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.col("_new").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marked = spans.withColumn("_new", F.coalesce(F.col("_on") > before, F.lit(True))).withColumn("_island", island)
    return marked.groupBy(*keys, "_island").agg(F.min("_on").alias("_on"), F.max("_off").alias("_off")).drop("_island")


def split_failures(
    cycles: DataFrame,
    detections: DataFrame,
    config: DataFrame,
    *,
    minutes: int = 60,
    first_seconds_of_red: float = 5,
    phases: tuple[int, ...] = (3, 4, 7, 8),
    threshold: float = 0.80,
    bin_seconds: int = 3600,
) -> DataFrame:
    """Cycles whose stop bar stays occupied in green and at the start of red.

    Greens and starts of red are asked for in one sweep. Phase 0 fails where any phase of the cycle does.
    """
    presence = config.select("SignalID", F.col("CallPhase").alias("Phase"), "Detector").distinct()
    de = detections.where(F.col("Phase").isin(*phases)).join(presence, ["SignalID", "Phase", "Detector"], "left_semi").select(
        "SignalID", "Phase", "Date", "Detector", F.col("DetTimeStamp").alias("DetOn"),
        plus_seconds("DetTimeStamp", F.col("DetDuration")).alias("DetOff"),
    )
    green = F.col("EventCode") == 1
    spans = cycles.where(F.col("Phase").isin(*phases) & F.col("EventCode").isin(1, 9)).select(
        "SignalID", "Phase", "Date", "CycleStart", green.alias("_green"), F.col("PhaseStart").alias("IntervalStart"),
        F.when(green, F.col("PhaseEnd")).otherwise(plus_seconds("PhaseStart", F.lit(first_seconds_of_red))).alias("IntervalEnd"))
    occupied = occupancy(de, spans, by=("CycleStart", "_green"), bin_seconds=bin_seconds)
    full = lambda kind: F.coalesce(F.max(F.when(kind, F.col("occ"))), F.lit(0.0)) > threshold
    keys = ["SignalID", "Phase", "Date", "CycleStart"]
    sf = occupied.groupBy(*keys).agg((full(F.col("_green")) & full(~F.col("_green"))).cast("int").alias("sf"))
    any_phase = sf.groupBy("SignalID", "Date", "CycleStart").agg(F.max("sf").alias("sf")).withColumn("Phase", F.lit(0))
    return failure_rates(sf.unionByName(any_phase), minutes)


def failure_rates(per_cycle: DataFrame, minutes: int = 60) -> DataFrame:
    """Failures, cycles and their ratio by signal, phase and period (also M13's shape)."""
    per = per_cycle.groupBy(
        "SignalID", F.col("Phase").alias("CallPhase"), floor_minutes("CycleStart", minutes).alias("Date_Hour")
    ).agg(F.sum("sf").cast("int").alias("sf"), F.count("*").alias("cycles"))
    per = per.withColumn("sf_freq", F.col("sf") / F.col("cycles")).withColumn("Date", F.to_date("Date_Hour"))
    return _calendar(per)


def shape_split_failures(hourly: DataFrame) -> DataFrame:
    """Older hourly split failures in the columns of the measure tables."""
    return _calendar(
        hourly.select(
            "SignalID", F.col("Phase").alias("CallPhase"), F.to_date("Hour").alias("Date"), F.col("Hour").alias("Date_Hour"),
            "sf", "cycles", "sf_freq",
        )
    )


def split_failures_by_peak(sf: DataFrame, period: str = "Date_Hour") -> DataFrame:
    """Daily frequency in peak and off-peak hours, told apart by a column."""
    peak = F.when(is_peak(period), "Peak").otherwise("Off_Peak")
    return sf.groupBy("SignalID", F.to_date(period).alias("Date"), peak.alias("Peak")).agg(
        wmean("sf_freq", "cycles").alias("sf_freq"), sum0("cycles").alias("cycles")
    )


def split_failures_red_start(
    cycles: DataFrame, detections: DataFrame, *, minutes: int = 60, max_span: float = 200, min_post: float = 10,
    side_phases_only: bool = True, bin_seconds: int = 3600,
) -> DataFrame:
    """Older method: the first detection ending after the start of red spans it."""
    side = ~F.col("Phase").isin(2, 6) if side_phases_only else F.lit(True)
    red = cycles.where(F.col("EventCode") == 9).where(side).select("SignalID", "Date", "Phase", "PhaseStart").distinct()
    de = detections.where(side).select(
        "SignalID", "Date", "Phase", F.col("DetTimeStamp").alias("DetOn"),
        plus_seconds("DetTimeStamp", F.col("DetDuration")).alias("DetOff"),
    ).distinct()
    met = asof(
        red, de, ["SignalID", "Phase", "Date"], "PhaseStart", "DetOff", ["DetOn"], forward=True, bin_seconds=bin_seconds
    )
    pre, post = seconds_between("PhaseStart", "DetOn"), seconds_between("PhaseStart", "DetOff")
    failed = (pre < 0) & (post > min_post) & (post - pre < max_span)
    return (
        met.withColumn("_f", F.coalesce(failed, F.lit(False)).cast("int"))
        .groupBy("SignalID", "Phase", floor_minutes("PhaseStart", minutes).alias("Hour"))
        .agg(F.sum("_f").cast("int").alias("sf"), F.count("*").alias("cycles"))
        .withColumn("sf_freq", F.col("sf") / F.col("cycles"))
    )


# Queue spillback ----------------------------------------------------------------------------


def queue_spillback(
    detections: DataFrame, config: DataFrame, *, minutes: int = 60, threshold: float = 3, approximate: bool = False
) -> DataFrame:
    """Share of cycles whose 95th percentile actuation exceeds the threshold."""
    p95 = F.percentile_approx("DetDuration", 0.95) if approximate else F.percentile("DetDuration", 0.95)
    dc = config.select("SignalID", F.col("CallPhase").alias("Phase"), "Detector", *(["Date"] if "Date" in config.columns else []))
    watched = detections.join(dc.distinct(), dc.columns, "left_semi")
    per_detector = watched.groupBy("Date", "SignalID", "CycleStart", "Phase", "Detector").agg(p95.alias("occ"))
    per_cycle = per_detector.groupBy("Date", "SignalID", "CycleStart", "Phase").agg(F.max("occ").alias("occ"))
    per = per_cycle.groupBy(
        "Date", "SignalID", F.col("Phase").alias("CallPhase"), floor_minutes("CycleStart", minutes).alias("Date_Hour")
    ).agg(F.count_if(F.col("occ") > threshold).cast("int").alias("qs"), F.count("*").cast("int").alias("cycles"))
    return _calendar(per.withColumn("qs_freq", F.col("qs") / F.col("cycles")))


# Delay --------------------------------------------------------------------------------------


def ped_delay(
    events: DataFrame, *, max_free: float = 300, fill_cycle_length: bool = True, bin_seconds: int = 3600
) -> DataFrame:
    """Mean wait for walk per signal and day, free or coordinated.

    A coordinated press is timed from its clearance, in a cycle length carried down
    (``fill_cycle_length=False`` keeps it on its own event only, which drops every
    coordinated wait).
    """
    code = F.col("EventCode")
    rows = events.where(code.isin(45, 21, 22, 132)).select(
        "SignalID", "Date", "Timestamp", "EventCode", F.col("EventParam").alias("Phase")
    )
    lengths = rows.where(code == 132)
    if fill_cycle_length:
        rows = carry(
            rows, ["SignalID", "Date"], "Timestamp", [Mark("CycleLength", code == 132, F.col("Phase"))],
            source=lengths, rank=F.when(code == 132, F.col("Phase")).otherwise(F.lit(LAST)), bin_seconds=bin_seconds,
        )
    else:
        rows = rows.withColumn("CycleLength", F.lit(None).cast("int"))
    longest = lengths.groupBy("SignalID", "Date").agg(F.max("Phase").alias("_cl"))
    rows = rows.where(code != 132).join(longest, ["SignalID", "Date"], "left")
    rows = rows.withColumn("Pattern", F.when(F.coalesce("_cl", F.lit(0)) == 0, "Free").otherwise("Coordinated"))
    rows = rows.where((F.col("Pattern") == "Free") | (F.coalesce("CycleLength", F.lit(0)) != 0))
    nxt = F.struct(F.col("Timestamp").alias("at"), code.alias("code"))
    rows = carry(
        rows, ["SignalID", "Phase", "Date"], "Timestamp", [Mark("_next", F.lit(True), nxt, strict=True)],
        rank=-code, forward=True, bin_seconds=bin_seconds,
    )
    free = (F.col("Pattern") == "Free") & (code == 45)
    coordinated = (F.col("Pattern") == "Coordinated") & (code == 22)
    waits = rows.where((F.col("_next.code") == 21) & (free | coordinated)).withColumn(
        "Delay", seconds_between("Timestamp", "_next.at")
    )
    kept = F.when(F.col("Pattern") == "Free", F.col("Delay") <= max_free).otherwise(F.col("Delay") <= F.col("CycleLength"))
    # The events-weighted mean of the phase means is the mean over the events.
    return waits.where(kept).groupBy("SignalID", "Date", "Pattern").agg(
        F.avg("Delay").alias("Avg_Max_Ped_Delay"), F.count("*").alias("Events")
    )


def approach_delay(
    detections: DataFrame,
    cycles: DataFrame,
    events: DataFrame,
    *,
    minutes: int = 60,
    config: DataFrame | None = None,
    nominal_cycle: float = 180,
    bin_seconds: int = 3600,
) -> DataFrame:
    """Mean wait from arrival at the stop bar to the next green, 0 on green.

    Waits of three cycle lengths or more are left out. Every period of a signal's day
    appears, with 0 where there was nothing. The volume-weighted mean of the phase
    means is the mean over the vehicles.
    """
    de = detections if config is None else detections.join(config.select("SignalID", "Detector").distinct(), ["SignalID", "Detector"], "left_semi")
    greens = cycles.where("EventCode = 1").select("SignalID", "Date", "Phase", F.col("PhaseStart").alias("GreenStart")).distinct()
    waits = asof(
        de, greens, ["SignalID", "Phase", "Date"], "DetTimeStamp", "GreenStart", [], forward=True, bin_seconds=bin_seconds
    ).withColumn("delay", F.when(F.col("EventCode") == 1, 0.0).otherwise(seconds_between("DetTimeStamp", "GreenStart")))
    lengths = events.where("EventCode = 132").select(
        "SignalID", "Date", F.col("Timestamp").alias("_set"),
        F.when(F.col("EventParam") != 0, F.col("EventParam")).alias("CycleLength"),
    )
    longest = lengths.groupBy("SignalID", "Date").agg(F.max("CycleLength").alias("_max"))
    timed = asof(
        waits.select("SignalID", "Date", "Phase", "DetTimeStamp", "CycleStart", "delay"), lengths,
        ["SignalID", "Date"], "CycleStart", "_set", ["CycleLength"], bin_seconds=bin_seconds,
    ).join(longest, ["SignalID", "Date"], "left")
    limit = F.coalesce(F.col("CycleLength").cast("double"), F.when(F.col("_max") > 0, F.col("_max").cast("double")), F.lit(float(nominal_cycle)))
    kept = timed.where(F.col("delay") < limit * 3)
    found = kept.groupBy("SignalID", "Date", floor_minutes("DetTimeStamp", minutes).alias("Hour")).agg(
        F.avg("delay").alias("delay"), F.count("delay").alias("vol")
    )
    starts = F.sequence(
        midnight("Date"), midnight("Date") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1440 - minutes)),
        F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes)),
    )
    # arrivals that travel past midnight belong to no period of their day
    grid = detections.select("SignalID", "Date").distinct().select("SignalID", "Date", F.explode(starts).alias("Hour"))
    return grid.join(found, ["SignalID", "Date", "Hour"], "left").select(
        "SignalID", "Hour", F.coalesce("delay", F.lit(0.0)).alias("delay"), F.coalesce("vol", F.lit(0)).alias("vol")
    )


def time_in_transition(events: DataFrame, *, bin_seconds: int = 3600) -> DataFrame:
    """Minutes and cycles spent moving between coordination plans, per signal and day."""
    coord = events.where("EventCode = 150").select("SignalID", "Date", "Timestamp", F.col("EventParam").alias("state"))
    key = ["SignalID", "Date"]
    # the row before, which may be of the same instant; a signal's day has few plan changes
    coord = coord.withColumn("_prev", F.lag("state").over(Window.partitionBy(*key).orderBy("Timestamp", "state")))
    ends = carry(
        coord, key, "Timestamp",
        [
            Mark("_five", F.col("state") == 5, F.col("Timestamp"), strict=True),
        ],
        rank=F.col("state"), bin_seconds=bin_seconds,
    ).where((F.col("state") == 5) & (F.col("_prev") == 1)).select(
        *key, F.col("Timestamp").alias("endTimestamp"), seconds_between("_five", "Timestamp").alias("CycleLength")
    )
    starts = coord.where(F.col("state").isin(2, 3, 4))
    met = asof(
        starts, ends, key, "Timestamp", "endTimestamp", ["CycleLength"], forward=True, bin_seconds=bin_seconds
    ).where("endTimestamp is not null")
    longest = met.groupBy(*key, "endTimestamp").agg(
        F.min("Timestamp").alias("_start"), F.first("CycleLength").alias("CycleLength")
    )
    seconds = seconds_between("_start", "endTimestamp")
    each = longest.select(
        *key, (seconds / 60).alias("t"), F.coalesce(F.ceil(F.try_divide(seconds, F.col("CycleLength"))).cast("double"), F.lit(1.0)).alias("c")
    )
    def five(c):
        return [F.min(c).alias(f"{names[c]}_min"), F.median(c).alias(f"{names[c]}_median"), F.max(c).alias(f"{names[c]}_max")]
    names = {"t": "TimeInTransition", "c": "CyclesInTransition"}
    return each.groupBy(*key).agg(
        *five("t"), F.count("*").alias("Transitions"), F.sum("t").alias("tint"),
        *five("c"), F.sum("c").alias("CyclesInTransition_sum"),
    )


# Detection levels and terminations ----------------------------------------------------------


def detection_levels(config: DataFrame, signals: DataFrame | None = None) -> DataFrame:
    """Detection level of each signal; a detector of no level leaves it unknown, then 0."""
    kinds, main = F.col("DetectionTypeDesc"), F.col("CallPhase").isin(2, 6)
    level = (
        F.when(kinds.contains("Advanced Count") & main, 1)
        .when(kinds.contains("Stop Bar Presence") & ~main, 1)
        .when(kinds.contains("Stop Bar Presence") & main, 2)
        .when(kinds.contains("Lane-by-lane Count"), 3)
    )
    day = ["Date"] if "Date" in config.columns else []
    by_signal = config.withColumn("_l", level).groupBy("SignalID", *day).agg(
        F.when(~F.bool_or(F.col("_l").isNull()), F.max("_l")).alias("Level")
    )
    if signals is None:
        return by_signal
    listed = signals.select("SignalID").distinct()
    return listed.join(by_signal, "SignalID", "left").withColumn("Level", F.coalesce("Level", F.lit(0)))


def terminations(cycles: DataFrame) -> DataFrame:
    """Greens ended by gap-out, max-out and force-off, as shares per signal and phase."""
    kind = F.col("TermType")
    n = F.count("*")

    def share(c) -> Column:
        return F.count_if(kind == c) / n

    return cycles.where((F.col("EventCode") == 1) & (kind != 0)).groupBy(
        "SignalID", F.col("Phase").alias("CallPhase"), "Date"
    ).agg(n.alias("Cycles"), share(4).alias("GapOut"), share(5).alias("MaxOut"), share(6).alias("ForceOff"))

