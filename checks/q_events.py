"""Event pairing, attribution and wide events."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.views_sql import hour, pairs, plus, secs
from phasewright.functions.calendar import floor_hour, plus_seconds
from phasewright.operators import events as E
from phasewright.operators import wide as W
from phasewright.plans.daily import event_tables


@query(
    "e01_add_barriers", "SignalID, Timestamp, EventCode:int, EventParam:int",
    """SELECT SignalID, Timestamp, EventCode, EventParam FROM event_log UNION ALL
    SELECT SignalID, Timestamp, 31, CASE WHEN a = 'major' AND z = 'minor' THEN 1 ELSE 2 END FROM (
      SELECT SignalID, Timestamp, max(CASE WHEN EventCode = 0 THEN g END) AS a, max(CASE WHEN EventCode = 12 THEN g END) AS z
      FROM (SELECT *, CASE WHEN EventParam IN (1,2,5,6) THEN 'major' WHEN EventParam IN (3,4,7,8) THEN 'minor' END AS g
            FROM event_log WHERE EventCode IN (0, 12)) GROUP BY ALL) WHERE a <> z""",
)
def _(v):
    return E.add_barriers(v.event_log())


PAIR_COLS = "SignalID, EventParam:int, Date, StartTimeStamp, EndTimeStamp, EventCode:int, ~Duration"


@query("e02_pairs_detector", PAIR_COLS, pairs("event_log_day", 82, 81))
def _(v):
    return E.pairs(v.event_log_day(), [82], [81])


@query("e03_green_time", PAIR_COLS, "SELECT * FROM green_pairs")
def _(v):
    return E.green_time(v.event_log_day())


@query("e03_yellow_time", PAIR_COLS, "SELECT * FROM yellow_pairs")
def _(v):
    return E.yellow_time(v.event_log_day())


@query("e03_red_time", PAIR_COLS, "SELECT * FROM red_pairs")
def _(v):
    return E.red_time(v.event_log_day())


@query("e03_phase_cycle", PAIR_COLS, pairs("event_log_day", 1, 1))
def _(v):
    return E.phase_cycle(v.event_log_day())


@query(
    "e04_assign_cycle",
    "SignalID, Phase:int, CycleStart, StartTimeStamp, EndTimeStamp, EventCode:int, ~Duration, ~TimeInCycle", "SELECT * FROM gyr",
)
def _(v):
    return E.phase_intervals(v.stored_day())


@query(
    "e05_detector_pairs", "SignalID, Phase:int, Detector:int, DetTimeStamp, ~DetDuration, CountDetector", "SELECT * FROM det_pairs",
)
def _(v):
    return E.detector_pairs(v.event_log_day(), E.count_detector_flag(v.det_config()))


@query("e06_volume_by_phase", "SignalID, Phase:int, PhaseStart, EventCode:int, CycleStart, ~Duration, Volume:bigint", "SELECT * FROM cycles")
def _(v):
    log = v.stored_day()
    spans = E.phase_intervals(log)
    hits = E.attribute_detections(spans, E.detector_pairs(log, E.count_detector_flag(v.det_config())))
    return E.volume_by_phase(spans, hits)


@query(
    "e07_cycles",
    "SignalID, Date, Phase:int, CycleStart, PhaseStart, PhaseEnd, EventCode:int, TermType:int, ~Duration, Volume:bigint",
    "SELECT * FROM cycles",
)
def _(v):
    return E.etl(v.stored_day(), E.count_detector_flag(v.det_config()))[0]


@query(
    "e07_detections",
    "SignalID, Date, Phase:int, Detector:int, CycleStart, PhaseStart, EventCode:int, DetTimeStamp, ~DetDuration, ~DetTimeInCycle, ~DetTimeInPhase",
    "SELECT * FROM detections",
)
def _(v):
    return E.etl(v.stored_day(), E.count_detector_flag(v.det_config()))[1]


@query(
    "e08_count_detector_flag", "SignalID, Detector:int, Timeperiod, CountDetector, vol:int",
    "SELECT c.SignalID, c.Detector, Timeperiod, CountDetector, vol FROM counts_1h c JOIN count_config k ON c.SignalID = k.SignalID AND c.Detector = k.Detector",
)
def _(v):
    from phasewright.operators.counts import counts

    return counts(v.event_log(), v.det_config()).join(
        E.count_detector_flag(v.det_config()).select("SignalID", "Detector", "CountDetector"), ["SignalID", "Detector"]
    )


@query(
    "e09_derive_on_codes", "SignalID, Timestamp, EventCode:int, EventParam:int, Phase:int",
    "SELECT *, CASE WHEN EventCode IN (0, 1, 8, 9, 12) THEN EventParam END AS Phase FROM event_log",
)
def _(v):
    return W.derive_on_codes(v.event_log(), (0, 1, 8, 9, 12), "EventParam", "Phase")


@query(
    "e10_copy_down", "SignalID, Timestamp, EventCode:int, EventParam:int, CycleLength:int",
    """SELECT SignalID, Timestamp, EventCode, EventParam, last_value(m IGNORE NULLS) OVER (PARTITION BY SignalID ORDER BY Timestamp
      RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS CycleLength FROM (SELECT *, max(CASE WHEN EventCode = 132 THEN EventParam END)
      OVER (PARTITION BY SignalID, Timestamp) AS m FROM event_log_day)""",
)
def _(v):
    return W.copy_updown(v.event_log_day(), [132], "CycleLength", [], "EventParam")


@query(
    "e10_copy_up", "SignalID, Timestamp, EventCode:int, EventParam:int, DetectorOff",
    """SELECT SignalID, Timestamp, EventCode, EventParam, CASE WHEN EventCode IN (81, 82) THEN first_value(m IGNORE NULLS) OVER
      (PARTITION BY SignalID, g ORDER BY Timestamp, EventCode, EventParam ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) END AS DetectorOff
      FROM (SELECT *, CASE WHEN EventCode IN (81, 82) THEN EventParam END AS g, CASE WHEN EventCode = 81 THEN Timestamp END AS m FROM event_log_day)""",
)
def _(v):
    rows = v.event_log_day().withColumn("Detector", F.when(F.col("EventCode").isin(81, 82), F.col("EventParam")))
    return W.copy_updown(rows, [81], "DetectorOff", ["Detector"], "Timestamp", up=True, spread=None)


@query(
    "e10_copy_down_off_code", "SignalID, Timestamp, EventCode:int, EventParam:int, Flash:int",
    """SELECT SignalID, Timestamp, EventCode, EventParam, nullif(last_value(m IGNORE NULLS) OVER (PARTITION BY SignalID ORDER BY Timestamp,
      EventCode, EventParam ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS Flash FROM (SELECT *, CASE WHEN EventCode = 150 THEN -1
      ELSE max(CASE WHEN EventCode = 173 THEN EventParam END) OVER (PARTITION BY SignalID, Timestamp) END AS m FROM event_log_day)""",
)
def _(v):
    return W.copy_updown(v.event_log_day(), [173], "Flash", [], "EventParam", off=150)


_SHIFTED = """SELECT e.SignalID, CASE WHEN e.EventCode IN (81, 82) AND k.Detector IS NOT NULL
   THEN e.Timestamp + to_microseconds(cast(k.TimeFromStopBar * 1e6 as bigint)) ELSE e.Timestamp END AS Timestamp, e.EventCode, e.EventParam,
   CASE WHEN e.EventCode IN (81, 82) THEN e.EventParam END AS Detector,
   CASE WHEN e.EventCode IN (81, 82) THEN k.CallPhase WHEN e.EventCode <= 24 OR e.EventCode BETWEEN 41 AND 49 THEN e.EventParam END AS Phase,
   CASE WHEN e.EventCode IN (89, 90) THEN e.EventParam END AS PedInput
   FROM event_log_day e LEFT JOIN det_config k ON e.SignalID = k.SignalID AND e.EventParam = k.Detector WHERE e.EventCode NOT IN (43, 44)"""


def _fill(value: str, group: str, order: str = "Timestamp, EventCode, EventParam") -> str:
    return (f"last_value({value} IGNORE NULLS) OVER (PARTITION BY SignalID{group} ORDER BY {order} "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")


WIDE_SQL = f"""SELECT Timestamp, SignalID, EventCode, EventParam, Detector, Phase, {_fill('ring', '')} AS Ring, {_fill('cyc', '')} AS CycleStart,
  {_fill('len', '')} AS CycleLength, {_fill('coord', '')} AS CoordState, {_fill('flash', '')} AS FlashStatus,
  CASE WHEN Phase IS NOT NULL THEN {_fill('ps', ', Phase')} END AS PhaseStart,
  CASE WHEN Phase IS NOT NULL THEN {_fill('iv', ', Phase')} END AS "Interval",
  CASE WHEN EventCode IN (4, 5, 6) THEN EventCode END AS TermType,
  CASE WHEN EventCode = 82 THEN det_off END AS DetectorOff, CASE WHEN EventCode = 82 THEN {secs('Timestamp', 'det_off')} END AS DetectorDuration
  FROM (SELECT *, first_value(CASE WHEN EventCode = 81 THEN Timestamp END IGNORE NULLS) OVER (PARTITION BY SignalID, Detector
      ORDER BY Timestamp, EventCode, EventParam ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS det_off FROM (
    SELECT *, max(CASE WHEN EventCode = 31 THEN EventParam END) OVER t AS ring,
    max(CASE WHEN EventCode = 31 AND EventParam = 1 THEN Timestamp END) OVER t AS cyc, max(CASE WHEN EventCode = 132 THEN EventParam END) OVER t AS len,
    max(CASE WHEN EventCode = 150 THEN EventParam END) OVER t AS coord, max(CASE WHEN EventCode = 173 THEN EventParam END) OVER t AS flash,
    max(CASE WHEN EventCode = 0 THEN Timestamp END) OVER t AS ps,
    max(CASE WHEN EventCode IN (1, 8, 10) THEN EventCode END) OVER (PARTITION BY SignalID, Timestamp, Phase) AS iv
    FROM ({_SHIFTED}) WINDOW t AS (PARTITION BY SignalID, Timestamp)))"""
_WIDE_ROWS = f"SELECT * FROM ({WIDE_SQL}) WHERE EventCode NOT IN (81, 89) AND cast(Timestamp as date) = date '2024-01-01'"


def _wide(v):
    return W.widen(v.event_log_day(), v.det_config().withColumn("Date", F.lit("2024-01-01").cast("date")))


@query(
    "e11_widen",
    "Timestamp, SignalID, EventCode:int, EventParam:int, Detector:int, Phase:int, Ring:int, CycleStart, CycleLength:int, CoordState:int, "
    "FlashStatus:int, PhaseStart, Interval:int, TermType:int, DetectorOff, ~DetectorDuration",
    _WIDE_ROWS,
)
def _(v):
    return _wide(v)


_SIGNAL_STATES = {
    "Ring": "EventCode = 31", "CoordPattern": "EventCode = 131", "CycleLength": "EventCode = 132", "CycleOffset": "EventCode = 133",
    "ActualCycleLength": "EventCode = 316", "ActualNaturalCycleLength": "EventCode = 317", "ActualCycleOffset": "EventCode = 318",
    "CoordState": "EventCode = 150", "FlashStatus": "EventCode = 173"}
_ORDER = "ORDER BY Timestamp, EventCode, EventParam ROWS BETWEEN"


def _lasting(name: str, key: str = "") -> str:
    """The stamp carried down to the end of the next day; a carried -1 is the end of the state."""
    held = f"last_value(CASE WHEN {name} IS NOT NULL THEN {{'v': {name}, 'd': Date}} END IGNORE NULLS) OVER (PARTITION BY SignalID{key} {_ORDER} UNBOUNDED PRECEDING AND CURRENT ROW)"
    some = f"{key[2:]} IS NOT NULL AND " if key else ""
    return f"CASE WHEN {some}({held}).d >= Date - 1 THEN ({held}).v END"


def _coming(name: str, key: str) -> str:
    """The next stamp of the day, or of an event of the day shifted past midnight."""
    held = f"first_value(CASE WHEN {name} IS NOT NULL THEN {{'v': {name}, 'd': Date, 'o': own}} END IGNORE NULLS) OVER (PARTITION BY SignalID, {key} {_ORDER} CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"CASE WHEN {key} IS NOT NULL AND (({held}).d = Date OR (({held}).d = Date + 1 AND ({held}).o = Date)) THEN ({held}).v END"


_DET = "EventCode BETWEEN 81 AND 88"
_MONTH_ROWS = f"""SELECT e.SignalID, e.EventCode, e.EventParam, e.Date AS own,
    CASE WHEN {_DET} THEN {plus('e.Timestamp', 'coalesce(k.TimeFromStopBar, 0)')} ELSE e.Timestamp END AS Timestamp,
    CASE WHEN {_DET} THEN e.EventParam END AS Detector, CASE WHEN EventCode IN (89, 90) THEN e.EventParam END AS PedInput,
    CASE WHEN EventCode IN (4, 5, 6) THEN EventCode END AS TermType,
    CASE WHEN {_DET} THEN k.CallPhase WHEN EventCode BETWEEN 134 AND 149 THEN EventCode - 133 WHEN EventCode BETWEEN 300 AND 315 THEN EventCode - 299
      WHEN EventCode BETWEEN 612 AND 651 THEN EventCode - 611 WHEN EventCode <= 24 OR EventCode BETWEEN 41 AND 49 OR EventCode = 151 THEN e.EventParam END AS Phase
  FROM event_log_full e LEFT JOIN det_config k ON e.SignalID = k.SignalID AND e.EventParam = k.Detector AND e.Date <= date '2024-01-31'
  WHERE EventCode NOT IN (43, 44)"""
_MONTH_STAMPS = f"""SELECT *, {', '.join(f'max(CASE WHEN {when} THEN EventParam END) OVER t AS s_{name}' for name, when in _SIGNAL_STATES.items())},
    max(CASE WHEN EventCode = 31 AND EventParam = 1 THEN Timestamp END) OVER t AS s_CycleStart,
    CASE WHEN EventCode = 182 THEN -1 ELSE max(CASE WHEN EventCode IN (183, 184) THEN EventParam END) OVER t END AS s_PowerFailure,
    max(CASE WHEN EventCode = 0 THEN Timestamp END) OVER t AS s_PhaseStart, max(CASE WHEN EventCode IN (1, 8, 10) THEN EventCode END) OVER p AS s_Interval,
    max(CASE WHEN EventCode BETWEEN 134 AND 149 THEN EventParam END) OVER p AS s_ProgrammedSplit,
    max(CASE WHEN EventCode BETWEEN 300 AND 315 THEN EventParam END) OVER p AS s_RecordedSplit,
    max(CASE WHEN EventCode BETWEEN 612 AND 651 THEN EventParam END) OVER t AS s_PedWait,
    CASE WHEN EventCode = 83 THEN -1 ELSE max(CASE WHEN EventCode BETWEEN 84 AND 88 THEN EventParam END) OVER t END AS s_DetectorFault,
    CASE WHEN EventCode = 81 THEN Timestamp END AS s_DetectorOff, CASE WHEN EventCode = 89 THEN Timestamp END AS s_PedInputOff
  FROM (SELECT *, cast(Timestamp as date) AS Date FROM ({_MONTH_ROWS}))
  WINDOW t AS (PARTITION BY SignalID, Timestamp), p AS (PARTITION BY SignalID, Timestamp, Phase)"""
_MONTH_FILLED = f"""SELECT Timestamp, SignalID, EventCode, EventParam, Date, Phase, TermType, Detector, PedInput,
    {', '.join(f'{_lasting("s_" + name)} AS "{name}"' for name in [*_SIGNAL_STATES, "CycleStart"])}, nullif({_lasting('s_PowerFailure')}, -1) AS PowerFailure,
    {', '.join(f'{_lasting("s_" + name, ", Phase")} AS "{name}"' for name in ("PhaseStart", "Interval", "ProgrammedSplit", "PedWait"))},
    nullif({_lasting('s_DetectorFault', ', Detector')}, -1) AS DetectorFault, {_coming('s_RecordedSplit', 'Phase')} AS RecordedSplit,
    CASE WHEN EventCode = 82 THEN {_coming('s_DetectorOff', 'Detector')} END AS DetectorOff,
    CASE WHEN EventCode = 90 THEN {_coming('s_PedInputOff', 'PedInput')} END AS PedInputOff FROM ({_MONTH_STAMPS})"""


@query(
    "e11_widen_month",
    "Timestamp, SignalID, EventCode:int, EventParam:int, Date, Ring:int, CycleStart, CoordPattern:int, CoordState:int, CycleLength:int, ActualCycleLength:int, "
    "ActualNaturalCycleLength:int, CycleOffset:int, ActualCycleOffset:int, FlashStatus:int, PowerFailure:int, Phase:int, PhaseStart, Interval:int, TermType:int, "
    "ProgrammedSplit:int, RecordedSplit:int, Detector:int, DetectorFault:int, DetectorOff, ~DetectorDuration, PedInput:int, PedWait:int, PedInputOff, ~PedInputDuration",
    f"""SELECT *, {secs('Timestamp', 'DetectorOff')} AS DetectorDuration, {secs('Timestamp', 'PedInputOff')} AS PedInputDuration
    FROM ({_MONTH_FILLED}) SEMI JOIN (SELECT DISTINCT SignalID, Date FROM event_log_full) USING (SignalID, Date) WHERE EventCode NOT IN (81, 89)""",
)
def _(v):
    return W.widen(v.event_log_full(), v.dated_det_config())


@query(
    "e12_channel_phase_mapping", "SignalID, Detector:int, CallPhase:int",
    """SELECT DISTINCT SignalID, Detector, CallPhase FROM (SELECT SignalID, Timestamp, min(EventParam) AS Detector FROM h WHERE EventCode = 82
      GROUP BY ALL HAVING count(*) = 1) JOIN (SELECT SignalID, Timestamp, min(EventParam) AS CallPhase FROM h WHERE EventCode = 90
      GROUP BY ALL HAVING count(*) = 1) USING (SignalID, Timestamp)""".replace(
        " h ", f" (SELECT DISTINCT SignalID, {hour('Timestamp')} AS Timestamp, EventCode, EventParam FROM event_log) h "),
)
def _(v):
    # Hours stand in for instants, and presses for phase calls: the log has no call codes.
    hours = v.event_log().withColumn("Timestamp", floor_hour("Timestamp")).distinct()
    return E.channel_phase_mapping(hours, 82, 90, lag_ms=0)


_CALLS = f"""SELECT DISTINCT SignalID, Timestamp, EventCode, EventParam FROM (SELECT SignalID, Timestamp, EventCode, EventParam FROM event_log WHERE EventCode = 82
  UNION ALL SELECT e.SignalID, {plus('e.Timestamp', '0.1')}, 43, k.CallPhase FROM event_log e JOIN det_config k ON e.SignalID = k.SignalID AND e.EventParam = k.Detector WHERE EventCode = 82)"""


@query(
    "e12_channel_phase_mapping_instants", "SignalID, Detector:int, CallPhase:int",
    f"""SELECT DISTINCT SignalID, Detector, CallPhase FROM (SELECT SignalID, Timestamp, min(EventParam) AS Detector FROM ({_CALLS}) WHERE EventCode = 82
      GROUP BY ALL HAVING count(*) = 1) JOIN (SELECT SignalID, {plus('Timestamp', '-0.1')} AS Timestamp, min(EventParam) AS CallPhase FROM ({_CALLS}) WHERE EventCode = 43
      GROUP BY ALL HAVING count(*) = 1) USING (SignalID, Timestamp)""",
)
def _(v):
    # Every actuation places its phase's call a tenth of a second later, as controllers log it.
    on = v.event_log().where("EventCode = 82").select("SignalID", "Timestamp", "EventCode", "EventParam", "Date")
    calls = on.join(v.det_config().select("SignalID", F.col("Detector").alias("EventParam"), "CallPhase"), ["SignalID", "EventParam"])
    calls = calls.select("SignalID", plus_seconds("Timestamp", F.lit(0.1)).alias("Timestamp"), F.lit(43).alias("EventCode"), F.col("CallPhase").alias("EventParam"), "Date")
    return E.channel_phase_mapping(on.unionByName(calls).distinct())


@query(
    "e13_arrivals_by_interval", "SignalID, Timeperiod, Phase:int, Interval, Vehicles:bigint, ~Percent",
    f"""SELECT *, Vehicles / sum(Vehicles) OVER (PARTITION BY SignalID, Timeperiod, Phase) AS Percent FROM (
      SELECT SignalID, {hour('Timestamp')} AS Timeperiod, Phase, CASE "Interval" WHEN 1 THEN 'Green' WHEN 8 THEN 'Yellow' ELSE 'Red' END
      AS "Interval", count(*) AS Vehicles FROM ({_WIDE_ROWS}) WHERE DetectorOff IS NOT NULL AND Phase IS NOT NULL
      AND "Interval" IS NOT NULL GROUP BY ALL)""",
)
def _(v):
    return W.arrivals_by_interval(_wide(v))


@query(
    "e14_wide_counts", "SignalID, Timeperiod, Detector:int, Phase:int, Vehicles:bigint",
    f"""SELECT SignalID, {hour('Timestamp')} AS Timeperiod, Detector, Phase, count(*) AS Vehicles FROM ({_WIDE_ROWS})
      WHERE DetectorOff IS NOT NULL GROUP BY ALL""",
)
def _(v):
    return W.wide_counts(_wide(v))


@query(
    "e15_wide_uptime", "SignalID, Timeperiod, ~uptime, ~response_ms",
    """SELECT SignalID, date_trunc('day', Timestamp) AS Timeperiod, nullif(count(*) FILTER (WHERE EventCode = 502 AND EventParam < 60), 0)
      / count(*) FILTER (WHERE EventCode = 502) AS uptime, avg(CASE WHEN EventCode = 503 THEN EventParam END) AS response_ms
      FROM event_log WHERE EventCode IN (502, 503) GROUP BY ALL""",
)
def _(v):
    # Parameters of the log stay below 100, so 40 is added to let some polls fail.
    log = v.event_log().where("EventCode in (502, 503)").withColumn("EventParam", F.col("EventParam") + 40)
    return W.wide_uptime(log)


@query(
    "e16_event_tables", "SignalID, Date, Phase:int, greens:bigint, vehicles:bigint, detections:bigint",
    """SELECT SignalID, Date, Phase, greens, vehicles, coalesce(n, 0) AS detections FROM (SELECT SignalID, Date, Phase,
      count(*) FILTER (WHERE EventCode = 1) AS greens, sum(Volume) AS vehicles FROM cycles GROUP BY ALL) LEFT JOIN
      (SELECT SignalID, Date, Phase, count(*) AS n FROM detections GROUP BY ALL) USING (SignalID, Date, Phase)""",
)
def _(v):
    tables = event_tables(v.stored_day(), v.det_config())
    key = ["SignalID", "Date", "Phase"]
    c = tables["cycles"].groupBy(*key).agg(F.count_if(F.col("EventCode") == 1).alias("greens"), F.sum("Volume").alias("vehicles"))
    d = tables["detections"].groupBy(*key).agg(F.count("*").alias("n"))
    return c.join(d, key, "left").withColumn("detections", F.coalesce("n", F.lit(0)))
