"""Event pairing and attribution: event log to phase intervals and detections.

Event frames carry SignalID, Timestamp, EventCode, EventParam and the processing Date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phasewright.functions.calendar import plus_seconds, seconds_between
from phasewright.operators.carry import LAST, Mark, asof, carry
from phasewright.session import stage

# Event codes of the controller log.
PHASE_ON, GREEN, YELLOW, RED, PHASE_END = 0, 1, 8, 9, 12
TERMINATIONS = (4, 5, 6)
BARRIER = 31
DETECTOR_OFF, DETECTOR_ON = 81, 82
ETL_CODES = (GREEN, YELLOW, RED, *TERMINATIONS, BARRIER, DETECTOR_OFF, DETECTOR_ON)
MAJOR_PHASES, MINOR_PHASES = (1, 2, 5, 6), (3, 4, 7, 8)


def add_barriers(events: DataFrame) -> DataFrame:
    """Insert barrier events where major phases end and minor ones start, or the reverse."""
    group = F.when(F.col("EventParam").isin(*MAJOR_PHASES), "major").when(
        F.col("EventParam").isin(*MINOR_PHASES), "minor"
    )
    instants = (
        events.where(F.col("EventCode").isin(PHASE_ON, PHASE_END))
        .withColumn("_group", group)
        .groupBy("SignalID", "Date", "Timestamp")
        .agg(
            F.max(F.when(F.col("EventCode") == PHASE_ON, F.col("_group"))).alias("_on"),
            F.max(F.when(F.col("EventCode") == PHASE_END, F.col("_group"))).alias("_end"),
        )
    )
    param = F.when((F.col("_on") == "major") & (F.col("_end") == "minor"), 1).when(
        (F.col("_on") == "minor") & (F.col("_end") == "major"), 2
    )
    barriers = instants.withColumn("EventParam", param).where("EventParam is not null").withColumn(
        "EventCode", F.lit(BARRIER)
    )
    return events.unionByName(barriers.select(*events.columns))


def _paired(rows: DataFrame, keys: list[str], kind: str, links: list, *, strict: bool, bin_seconds: int) -> DataFrame:
    """Ends with the start they close, for several kinds of pair in one pass.

    ``links`` lists end codes with their start codes. An end takes the latest start, and
    only the first end after a start keeps it: that is, the end before it must be older
    than the start. Ends tied for first drop.
    """
    at, code = F.col("Timestamp"), F.col(kind)
    marks = []
    for n, (ends, starts) in enumerate(links):
        marks.append(Mark(f"_from{n}", code.isin(*starts), at, strict))
        marks.append(Mark(f"_prior{n}", code.isin(*ends), at, True))
        if len(starts) > 1:
            marks.append(Mark(f"_code{n}", code.isin(*starts), code, strict))
    rank = None
    if any(len(starts) > 1 for _, starts in links):
        # Of several starts at one instant the greatest code counts.
        rank = F.when(code.isin(*[c for _, starts in links for c in starts]), code).otherwise(F.lit(LAST))
    out = carry(rows, keys, "Timestamp", marks, rank=rank, source=rows, bin_seconds=bin_seconds, count_same=[kind])
    found, found_code = F.lit(None), F.lit(None)
    for n, (ends, starts) in enumerate(links):
        start, prior = F.col(f"_from{n}"), F.col(f"_prior{n}")
        taken = prior > start if strict else prior >= start
        first = code.isin(*ends) & start.isNotNull() & ~F.coalesce(taken, F.lit(False))
        found = F.when(first, start).otherwise(found)
        found_code = F.when(first, F.col(f"_code{n}") if len(starts) > 1 else F.lit(starts[0])).otherwise(found_code)
    return out.withColumns({"_start": found, "_start_code": found_code}).where("_start is not null and _same = 1")


def _spans(paired: DataFrame, keys: list[str], name: str) -> DataFrame:
    return paired.select(
        *keys, F.col("_start").alias("StartTimeStamp"), F.col("Timestamp").alias("EndTimeStamp"),
        F.col("_start_code").alias(name), seconds_between("_start", "Timestamp").alias("Duration"),
    )


def pairs(
    events: DataFrame, start_codes: list[int], end_codes: list[int], field: str = "EventCode", *,
    strict: bool = False, bin_seconds: int = 3600,
) -> DataFrame:
    """Start/end pairs (E02): each end meets the latest start, each start keeps its first end.

    Ends tied for first drop out. An end exactly on the latest start counts unless
    ``strict``.
    """
    other = "EventParam" if field == "EventCode" else "EventCode"
    keys = ["SignalID", other, "Date"]
    rows = events.where(F.col(field).isin(*start_codes, *end_codes)).select(*keys, "Timestamp", field)
    links = [(tuple(end_codes), tuple(start_codes))]
    return _spans(_paired(rows, keys, field, links, strict=strict, bin_seconds=bin_seconds), keys, field)


def green_time(events: DataFrame, **kw) -> DataFrame:
    return pairs(events, [GREEN], [YELLOW], **kw)


def yellow_time(events: DataFrame, **kw) -> DataFrame:
    return pairs(events, [YELLOW], [RED], **kw)


def red_time(events: DataFrame, **kw) -> DataFrame:
    return pairs(events, [RED], [GREEN], **kw)


def phase_cycle(events: DataFrame, **kw) -> DataFrame:
    """Green to green; every green meets itself at 0 s unless ``strict``."""
    return pairs(events, [GREEN], [GREEN], **kw)


def colour_intervals(events: DataFrame, *, bin_seconds: int = 3600) -> DataFrame:
    """Green, yellow and red intervals of all phases, found in one pass."""
    keys = ["SignalID", "EventParam", "Date"]
    rows = events.where(F.col("EventCode").isin(GREEN, YELLOW, RED)).select(*keys, "Timestamp", "EventCode")
    links = [((YELLOW,), (GREEN,)), ((RED,), (YELLOW,)), ((GREEN,), (RED,))]
    return _spans(_paired(rows, keys, "EventCode", links, strict=False, bin_seconds=bin_seconds), keys, "EventCode")


def cycle_starts(events: DataFrame) -> DataFrame:
    return events.where((F.col("EventCode") == BARRIER) & (F.col("EventParam") == 1)).select(
        "SignalID", "Date", F.col("Timestamp").alias("CycleStart")
    ).distinct()


def assign_cycle(intervals: DataFrame, cycles: DataFrame, *, bin_seconds: int = 3600) -> DataFrame:
    """Latest cycle start of the signal at or before each interval; others drop."""
    out = asof(
        intervals, cycles, ["SignalID", "Date"], "StartTimeStamp", "CycleStart", [], bin_seconds=bin_seconds
    ).where("CycleStart is not null")
    return out.withColumnRenamed("EventParam", "Phase").withColumn(
        "TimeInCycle", seconds_between("CycleStart", "StartTimeStamp")
    )


def count_detector_flag(config: DataFrame) -> DataFrame:
    """CountDetector: the priority is the least of its signal and phase."""
    least = F.min("CountPriority").over(Window.partitionBy("SignalID", "CallPhase"))
    return config.withColumn("CountDetector", F.col("CountPriority") == least)


def detector_pairs(events: DataFrame, config: DataFrame, *, bin_seconds: int = 3600) -> DataFrame:
    """Detector on/off pairs mapped to phases, on-time moved to the stop bar.

    ``config`` is a detector list (signals times detectors); the optimizer broadcasts
    it only below its size threshold.
    """
    dc = config.select(
        "SignalID", F.col("Detector").alias("EventParam"), F.col("CallPhase").alias("Phase"),
        F.coalesce("TimeFromStopBar", F.lit(0.0)).alias("TimeFromStopBar"), "CountDetector",
    ).dropna()
    p = pairs(events, [DETECTOR_ON], [DETECTOR_OFF], bin_seconds=bin_seconds)
    return p.join(dc, ["SignalID", "EventParam"]).select(
        "SignalID", "Date", "Phase", F.col("EventParam").alias("Detector"),
        plus_seconds("StartTimeStamp", F.col("TimeFromStopBar")).alias("DetTimeStamp"),
        F.col("Duration").alias("DetDuration"), "CountDetector",
    )


def phase_intervals(events: DataFrame, *, bin_seconds: int = 3600) -> DataFrame:
    """Green, yellow and red intervals with their cycle start."""
    spans = colour_intervals(events, bin_seconds=bin_seconds)
    return assign_cycle(spans, cycle_starts(events), bin_seconds=bin_seconds)


def attribute_detections(
    intervals: DataFrame, detections: DataFrame, *, bin_seconds: int = 3600
) -> DataFrame:
    """Each detection with the phase interval in force at its time (E06, event level)."""
    right = intervals.select(
        "SignalID", "Date", "Phase", F.col("StartTimeStamp").alias("PhaseStart"), "CycleStart", "EventCode"
    )
    out = asof(
        detections, right, ["SignalID", "Phase", "Date"], "DetTimeStamp", "PhaseStart",
        ["CycleStart", "EventCode"], bin_seconds=bin_seconds,
    ).where("PhaseStart is not null")
    return out.withColumn("DetTimeInCycle", seconds_between("CycleStart", "DetTimeStamp")).withColumn(
        "DetTimeInPhase", seconds_between("PhaseStart", "DetTimeStamp")
    )


def volume_by_phase(intervals: DataFrame, attributed: DataFrame) -> DataFrame:
    """Phase intervals with the count of their count-detector actuations (E06, aggregated)."""
    on = ["SignalID", "Date", "Phase", "EventCode", "PhaseStart"]
    volumes = attributed.where("CountDetector").groupBy(*on).agg(F.count("*").alias("Volume"))
    spans = intervals.withColumnRenamed("StartTimeStamp", "PhaseStart").withColumnRenamed("EndTimeStamp", "PhaseEnd")
    return spans.join(volumes, on, "left").withColumn("Volume", F.coalesce("Volume", F.lit(0)))


def _with_both(events: DataFrame) -> DataFrame:
    """Signal-days that have a cycle start and a termination."""
    start = (F.col("EventCode") == BARRIER) & (F.col("EventParam") == 1)
    term = F.col("EventCode").isin(*TERMINATIONS)
    return (
        events.where(start | term).groupBy("SignalID", "Date")
        .agg(F.bool_or(start).alias("_c"), F.bool_or(term).alias("_t"))
        .where("_c and _t").select("SignalID", "Date")
    )


def etl(events: DataFrame, config: DataFrame, *, bin_seconds: int = 3600) -> tuple[DataFrame, DataFrame]:
    """Cycle and detection tables of every signal and day in the log.

    The intervals and the attributed detections are staged: both outputs need them.
    """
    coded = events.where(F.col("EventCode").isin(*ETL_CODES))
    usable = coded.join(_with_both(coded), ["SignalID", "Date"], "left_semi")
    intervals = stage(phase_intervals(usable, bin_seconds=bin_seconds))
    attributed = stage(attribute_detections(
        intervals, detector_pairs(usable, config, bin_seconds=bin_seconds), bin_seconds=bin_seconds
    ))
    terms = usable.where(F.col("EventCode").isin(*TERMINATIONS)).select(
        "SignalID", "Date", F.col("EventParam").alias("Phase"), F.col("Timestamp").alias("PhaseEnd"),
        F.col("EventCode").alias("TermType"),
    )
    cycles = (
        volume_by_phase(intervals, attributed)
        .join(terms, ["SignalID", "Date", "Phase", "PhaseEnd"], "left")
        .select(
            "SignalID", "Date", "Phase", "CycleStart", "PhaseStart", "PhaseEnd", "EventCode",
            F.coalesce("TermType", F.lit(0)).alias("TermType"), "Duration", "Volume",
        )
    )
    detections = attributed.select(
        "SignalID", "Date", "Phase", "Detector", "CycleStart", "PhaseStart", "EventCode",
        "DetTimeStamp", "DetDuration", "DetTimeInCycle", "DetTimeInPhase",
    )
    return cycles, detections


def channel_phase_mapping(events: DataFrame, channel_code: int = 82, phase_code: int = 43, lag_ms: int = 100) -> DataFrame:
    """Detector to phase by phase calls a fixed lag after the channel comes on.

    Instants with more than one match tell nothing and drop out.
    """
    channels = events.where(F.col("EventCode") == channel_code).select(
        "SignalID", "Timestamp", F.col("EventParam").alias("Detector")
    )
    calls = events.where(F.col("EventCode") == phase_code).select(
        "SignalID", (F.col("Timestamp") - F.make_dt_interval(secs=F.lit(lag_ms / 1000).cast("decimal(18,6)"))).alias("Timestamp"),
        F.col("EventParam").alias("CallPhase"),
    )
    # Counts per instant on each side decide uniqueness before anything is paired.
    one_channel = channels.groupBy("SignalID", "Timestamp").agg(F.count("*").alias("_n"), F.min("Detector").alias("Detector"))
    one_call = calls.groupBy("SignalID", "Timestamp").agg(F.count("*").alias("_m"), F.min("CallPhase").alias("CallPhase"))
    return (
        one_channel.join(one_call, ["SignalID", "Timestamp"]).where("_n = 1 and _m = 1")
        .select("SignalID", "Detector", "CallPhase").distinct()
    )
