"""Table schemas and the measures' descriptors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
_DATE, _TS = T.DateType(), T.TimestampNTZType()

EVENT_LOG = _struct(SignalID=_S, Timestamp=_TS, EventCode=_I, EventParam=_I, Date=_DATE)
DET_CONFIG = _struct(
    SignalID=_S, Detector=_I, CallPhase=_I, CountPriority=_I, TimeFromStopBar=_D, DistanceFromStopBar=_D,
    DetectionTypeDesc=_S, ApproachDesc=_S, LaneTypeDesc=_S, LaneNumber=_I, DateAdded=_TS,
)
PED_CONFIG = _struct(SignalID=_S, Detector=_I, CallPhase=_I)
CORRIDORS_RAW = _struct(
    SignalID=_S, Zone_Group=_S, Zone=_S, Corridor=_S, Subcorridor=_S, Agency=_S, Main_Street_Name=_S,
    Side_Street_Name=_S, Milepost=_D, Asof=_DATE, Duplicate=_D, Include=_B, Modified=_DATE, Note=_S,
    Latitude=_D, Longitude=_D,
)
CYCLES = _struct(
    SignalID=_S, Date=_DATE, Phase=_I, CycleStart=_TS, PhaseStart=_TS, PhaseEnd=_TS, EventCode=_I, TermType=_I,
    Duration=_D, Volume=_L,
)
DETECTIONS = _struct(
    SignalID=_S, Date=_DATE, Phase=_I, Detector=_I, CycleStart=_TS, PhaseStart=_TS, EventCode=_I, DetTimeStamp=_TS,
    DetDuration=_D, DetTimeInCycle=_D, DetTimeInPhase=_D,
)


@dataclass(frozen=True)
class Target:
    """How a table is published: the column of its periods (None: replaced whole), whether its windows begin on Tuesdays, its measure."""

    period: str | None
    weekly: bool = False
    variable: str | None = None


@dataclass(frozen=True)
class Metric:
    """What the rollups and readers need to know about a measure."""

    label: str
    variable: str
    table: str
    weight: str | None = None
    hourly_table: str | None = None
    peak_only: bool = False
    midweek_only: bool = False
    goal: float | None = None
    higher_is_better: bool = True


# Columns, tables and weights of the report's measures.
METRICS = {
    m.table: m
    for m in (
        Metric("Daily Volume", "vpd", "vpd", midweek_only=True),
        Metric("Morning Peak Volume", "vph", "vphpa", midweek_only=True),
        Metric("Evening Peak Volume", "vph", "vphpp", midweek_only=True),
        Metric("Throughput", "vph", "tp"),
        Metric("Arrivals on Green", "aog", "aogd", weight="vol", hourly_table="aogh", peak_only=True),
        Metric("Progression Ratio", "pr", "prd", weight="vol", hourly_table="prh", peak_only=True),
        Metric("Queue Spillback Rate", "qs_freq", "qsd", weight="cycles", hourly_table="qsh", peak_only=True, higher_is_better=False),
        Metric("Peak Split Failures", "sf_freq", "sfd", weight="cycles", hourly_table="sfh", higher_is_better=False),
        Metric("Off-Peak Split Failures", "sf_freq", "sfo", weight="cycles", higher_is_better=False),
        Metric("Time in Transition", "tint", "tint", higher_is_better=False),
        Metric("Approach Delay", "delay", "ad", weight="vol", hourly_table="adh", higher_is_better=False),
        Metric("Pedestrian Delay", "pd", "pd", weight="Events", higher_is_better=False),
        Metric("Travel Time Index", "tti", "tti", weight="pct", hourly_table="ttih", higher_is_better=False),
        Metric("Planning Time Index", "pti", "pti", weight="pct", hourly_table="ptih", higher_is_better=False),
        Metric("Average Speed", "spd", "spd", weight="pct", hourly_table="spdh"),
        Metric("Travel Time", "tt", "tt", weight="pct", hourly_table="tth", higher_is_better=False),
        Metric("Daily Pedestrian Activations", "papd", "papd", midweek_only=True),
        Metric("Detector Uptime", "uptime", "du", weight="all"),
        Metric("Pushbutton Uptime", "uptime", "pau", weight="all"),
        Metric("Communications Uptime", "uptime", "cu"),
        Metric("Detection Level", "Level", "dl"),
        Metric("Gap Outs", "GapOut", "go", weight="Cycles"),
        Metric("Max Outs", "MaxOut", "mo", weight="Cycles", higher_is_better=False),
        Metric("Force Offs", "ForceOff", "fo", weight="Cycles"),
    )
}
