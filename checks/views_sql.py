"""The views and intermediate results as SQL, prepended to a statement where it names them."""

from __future__ import annotations

import re

from phasewright.sources.views import MORE_CODES

DAY0 = "1704067200000000"

_CODE = """CASE event_type
 WHEN 'click' THEN CASE WHEN b <= 5 THEN 82 ELSE 81 END
 WHEN 'view' THEN CASE WHEN b <= 3 THEN 81 WHEN b <= 5 THEN 1 WHEN b <= 7 THEN 8 ELSE 9 END
 WHEN 'purchase' THEN CASE WHEN b <= 1 THEN 1 WHEN b <= 3 THEN 8 WHEN b <= 5 THEN 9 WHEN b = 6 THEN 4
   WHEN b = 7 THEN 5 WHEN b = 8 THEN 6 ELSE 31 END
 WHEN 'signup' THEN CASE WHEN b <= 3 THEN 90 WHEN b <= 5 THEN 45 WHEN b <= 7 THEN 21 ELSE 22 END
 WHEN 'error' THEN CASE WHEN b <= 1 THEN 132 WHEN b <= 5 THEN 150 WHEN b = 6 THEN 0 WHEN b = 7 THEN 12
   WHEN b = 8 THEN 173 ELSE 502 END END"""


def _log(name: str, signals: int, ts: str) -> dict[str, str]:
    """The event log with its companion rows."""
    return {
        f"{name}_k": f"SELECT cast(user_id % {signals} as varchar) AS SignalID, {ts} AS Timestamp, event_type, value, "
        "cast(regexp_extract(props, '([0-9]+)', 1) as int) AS k FROM events",
        f"{name}_b": f"SELECT *, cast(floor(k / 10) as int) AS b FROM {name}_k",
        f"{name}_c": f"SELECT *, {_CODE} AS code FROM {name}_b",
        f"{name}_p": f"""SELECT SignalID, Timestamp, k, code AS EventCode,
          cast(CASE WHEN code = 31 THEN 1 WHEN code = 132 THEN floor(value) WHEN code = 150 THEN k % 5 + 1
          WHEN code = 502 THEN k ELSE k % 8 + 1 END as int) AS EventParam FROM {name}_c WHERE code IS NOT NULL""",
        name: f"""SELECT SignalID, Timestamp, EventCode, EventParam, cast(Timestamp as date) AS Date FROM {name}_p
          UNION ALL SELECT SignalID, Timestamp, 4 + k % 3, EventParam, cast(Timestamp as date) FROM {name}_p WHERE EventCode = 8
          UNION ALL SELECT SignalID, Timestamp, 12, (EventParam + 2) % 8 + 1, cast(Timestamp as date) FROM {name}_p
          WHERE EventCode = 0""",
    }


WEEK = "cast(date_diff('day', date '2016-12-25', {d}) // 7 as int)"
DOW = "cast(extract(dow from {d}) + 1 as int)"


def week(d: str) -> str:
    return WEEK.format(d=d)


def dow(d: str) -> str:
    return DOW.format(d=d)


def hour(ts: str) -> str:
    return f"date_trunc('hour', {ts})"


def quarter_hour(ts: str) -> str:
    return f"time_bucket(interval '15 minutes', {ts}, timestamp '2000-01-01')"


def secs(a: str, b: str) -> str:
    return f"(date_diff('microsecond', {a}, {b}) / 1e6)"


def plus(ts: str, s: str) -> str:
    return f"({ts} + to_microseconds(cast(round(({s}) * 1e6) as bigint)))"


def wmean(v: str, w: str) -> str:
    return f"(sum({v} * {w}) / nullif(sum({w}) FILTER (WHERE {v} IS NOT NULL), 0))"


def delta(v: str, by: str, order: str) -> str:
    lag = f"lag({v}) OVER (PARTITION BY {by} ORDER BY {order})"
    return f"(({v} - {lag}) / nullif({lag}, 0))"


PEAK = "(6, 7, 8, 9, 15, 16, 17, 18, 19)"


def peak(ts: str) -> str:
    return f"extract(hour from {ts}) IN {PEAK}"


def pairs(log: str, a: int, b: int) -> str:
    """First end of each start, ends taking the latest start; ties for first drop."""
    return f"""SELECT SignalID, EventParam, Date, s AS StartTimeStamp, e AS EndTimeStamp, {a} AS EventCode,
      {secs('s', 'e')} AS Duration FROM (
      SELECT *, min(e) OVER (PARTITION BY SignalID, EventParam, Date, s) AS first_e,
        count(*) OVER (PARTITION BY SignalID, EventParam, Date, s, e) AS ties FROM (
        SELECT x.SignalID, x.EventParam, x.Date, x.Timestamp AS e, y.Timestamp AS s
        FROM (SELECT * FROM {log} WHERE EventCode = {b}) x ASOF JOIN
          (SELECT DISTINCT SignalID, EventParam, Date, Timestamp FROM {log} WHERE EventCode = {a}) y
        ON x.SignalID = y.SignalID AND x.EventParam = y.EventParam AND x.Date = y.Date AND x.Timestamp >= y.Timestamp))
      WHERE e = first_e AND ties = 1"""


def filtered(counts: str, config: str, step: int, limits: tuple) -> str:
    """Detector-day filter over a count view."""
    vol, vol_m, mad, mad_m, flat, hi = limits
    return f"""
    SELECT SignalID, Date, Timeperiod, Detector, CallPhase, CASE WHEN Good_Day = 1 THEN vol END AS vol, delta_vol,
      mean_abs_delta, flatlined, flat_strk, flat_flag, maxvol_flag, mad_flag, Good_Day,
      date_trunc('month', Timeperiod) + (Timeperiod - date_trunc('day', Timeperiod)) AS Month_Hour,
      date_trunc('year', Timeperiod) + (Timeperiod - date_trunc('day', Timeperiod)) AS Hour
    FROM (SELECT *, CASE WHEN flat_flag > 0 OR maxvol_flag > 0 OR mad_flag > 0 THEN 0
            WHEN NOT (flat_flag > 0 OR maxvol_flag > 0 OR mad_flag > 0) THEN 1 END AS Good_Day
    FROM (SELECT *, cast(flat_strk > {flat} as int) AS flat_flag,
      cast(CASE WHEN Mainline THEN hi_m > {hi} WHEN NOT Mainline THEN hi_p > {hi} END as int) AS maxvol_flag,
      cast(CASE WHEN Mainline THEN mean_abs_delta > {mad_m} WHEN NOT Mainline THEN mean_abs_delta > {mad} END as int) AS mad_flag
    FROM (SELECT *, cast(max(flatlined) OVER d as int) AS flat_strk, count(*) FILTER (WHERE vol > {vol}) OVER d AS hi_p,
      count(*) FILTER (WHERE vol > {vol_m}) OVER d AS hi_m, cast(ceil(avg(abs(delta_vol)) OVER d) as int) AS mean_abs_delta
    FROM (SELECT *, CASE WHEN extract(hour from Timeperiod) < 5 THEN 0.0 ELSE cast(row_number() OVER
        (PARTITION BY SignalID, Date, CallPhase, Detector, island ORDER BY Timeperiod) as double) END AS flatlined
    FROM (SELECT *, sum(chg) OVER (PARTITION BY SignalID, Date, CallPhase, Detector ORDER BY Timeperiod) AS island
    FROM (SELECT *, vol - lag(vol) OVER o AS delta_vol,
        CASE WHEN lvl = lag(lvl) OVER o THEN 0 ELSE 1 END AS chg
    FROM (SELECT *, CASE WHEN extract(hour from Timeperiod) < 5 THEN -1.0 ELSE vol END AS lvl
    FROM (SELECT coalesce(g.SignalID, c.SignalID) AS SignalID, coalesce(g.Timeperiod, c.Timeperiod) AS Timeperiod,
        coalesce(g.Detector, c.Detector) AS Detector, coalesce(g.CallPhase, c.CallPhase) AS CallPhase, g.Mainline,
        coalesce(cast(c.vol as double), 0.0) AS vol, cast(coalesce(g.Timeperiod, c.Timeperiod) as date) AS Date
      FROM (SELECT DISTINCT k.SignalID, k.Detector, k.CallPhase, k.ApproachDesc LIKE '%Mainline%' AS Mainline, t.t AS Timeperiod
            FROM {config} k, (SELECT unnest(generate_series(cast(d as timestamp), cast(d as timestamp) + interval 1 day
              - interval {step} minute, interval {step} minute)) AS t
              FROM (SELECT DISTINCT cast(Timeperiod as date) AS d FROM {counts} WHERE CallPhase IS NOT NULL)) t) g
      FULL JOIN (SELECT * FROM {counts} WHERE CallPhase IS NOT NULL) c
      ON g.SignalID = c.SignalID AND g.Timeperiod = c.Timeperiod AND g.Detector = c.Detector AND g.CallPhase = c.CallPhase))
    WINDOW o AS (PARTITION BY SignalID, Date, CallPhase, Detector ORDER BY Timeperiod))))
    WINDOW d AS (PARTITION BY SignalID, Date, CallPhase, Detector))))"""


def adjusted(fc: str) -> str:
    return f"""
    SELECT SignalID, CallPhase, Detector, Timeperiod, cast(floor(coalesce(v, med)) as int) AS vol, cast(Timeperiod as date) AS Date
    FROM (SELECT *, median(v) OVER (PARTITION BY SignalID, CallPhase, Detector, DOW, Month_Hour) AS med
    FROM (SELECT *, coalesce(vol, CASE WHEN pv <= 3000 THEN floor(pv * share) END) AS v
    FROM (SELECT w.*, s.share, CASE WHEN NOT coalesce(bool_or(s.share = 0 AND w.vol > 0) OVER p, false)
        THEN avg(w.vol / nullif(s.share, 0)) OVER p END AS pv
    FROM (SELECT *, {dow('Timeperiod')} AS DOW, date_trunc('month', Timeperiod) AS mon,
        count(*) FILTER (WHERE vol IS NULL) OVER (PARTITION BY SignalID, CallPhase, Timeperiod) = 0 AS whole FROM {fc}) w
    LEFT JOIN (SELECT SignalID, CallPhase, mon, Detector, v / nullif(sum(v) OVER (PARTITION BY SignalID, CallPhase, mon), 0) AS share
      FROM (SELECT SignalID, CallPhase, date_trunc('month', Timeperiod) AS mon, Detector, sum(vol) AS v FROM (SELECT *,
        count(*) FILTER (WHERE vol IS NULL) OVER (PARTITION BY SignalID, CallPhase, Timeperiod) AS nn FROM {fc}) WHERE nn = 0
        GROUP BY ALL)) s USING (SignalID, CallPhase, mon, Detector)
    WINDOW p AS (PARTITION BY w.SignalID, w.CallPhase, w.Timeperiod)))) WHERE coalesce(v, med) IS NOT NULL"""


def corridor_cte(src: str, level: str, per: str, v: str, w: str, keep: bool = False, extra: str = "") -> str:
    """Corridor means of a signal-level source on a hierarchy view."""
    inner = f"""SELECT h.Zone_Group, h.Zone, h.Corridor, s.{per}, {wmean('s.' + v, 's.' + w)} AS {v}, coalesce(sum(s.{w}), 0) AS {w}
      FROM {src} s JOIN {level} h USING (SignalID) WHERE h.Corridor IS NOT NULL {extra} GROUP BY ALL"""
    out = f"SELECT *, {delta(v, 'Zone_Group, Zone, Corridor', per)} AS delta FROM ({inner})"
    return out if keep else f"SELECT * FROM ({out}) WHERE {v} IS NOT NULL"


def zone_union(cor: str, per: str, v: str, w: str) -> str:
    """Corridor rows under their zone with the zone-group rows."""
    return f"""SELECT DISTINCT * FROM (SELECT Zone AS Zone_Group, Corridor, {per}, {v}, {w}, delta FROM ({cor})
      UNION ALL SELECT *, {delta(v, 'Zone_Group', per)} AS delta FROM (
      SELECT Zone_Group, Zone_Group AS Corridor, {per}, {wmean(v, w)} AS {v}, coalesce(sum({w}), 0) AS {w} FROM ({cor}) GROUP BY ALL))"""


def rollup(src: str, per: str, v: str, w: str = "ones", level: str = "corridors", keep: bool = False) -> str:
    source = f"(SELECT *, 1 AS ones FROM {src})" if w == "ones" else src
    return zone_union(corridor_cte(source, level, per, v, w, keep), per, v, w)


VIEWS: dict[str, str] = {
    **_log("event_log", 25, "ts"),
    **_log("day_raw", 5, f"make_timestamp({DAY0} + (epoch_us(ts) - {DAY0}) // 30)"),
    "event_log_day": "SELECT DISTINCT * FROM day_raw",
    "event_log_full": f"""SELECT DISTINCT * FROM (SELECT * FROM event_log UNION ALL
      SELECT SignalID, Timestamp, EventCode, EventParam, cast(Timestamp as date) FROM (
      SELECT cast(user_id % 25 as varchar) AS SignalID, ts AS Timestamp, {list(MORE_CODES)}[(event_id % {len(MORE_CODES)} + 1)::int] AS EventCode,
        cast(regexp_extract(props, '([0-9]+)', 1) as int) % 8 + 1 AS EventParam FROM events
      UNION ALL SELECT cast(user_id % 25 as varchar), CASE WHEN k >= CASE WHEN event_type = 'click' THEN 80 ELSE 50 END
        THEN date_trunc('day', ts) + to_seconds(86399) ELSE ts END, CASE WHEN event_type = 'click' THEN 82 ELSE 81 END, k % 8 + 1
        FROM (SELECT *, cast(regexp_extract(props, '([0-9]+)', 1) as int) AS k FROM events) WHERE event_type IN ('click', 'view')))""",
    "corridors": """SELECT cast(n_nationkey as varchar) AS SignalID, 'GROUP_' || (n_regionkey % 2) AS Zone_Group,
      'ZONE_' || (n_regionkey % 2) AS Zone, r_name AS Corridor, r_name || '-' || (n_nationkey // 5 % 2) AS Subcorridor,
      n_name || ' @ ' || r_name AS Name, n_nationkey || ': ' || n_name || ' @ ' || r_name AS Description,
      date '2024-01-01' AS "Asof", CASE WHEN n_nationkey % 6 <> 5 THEN 33.0::double + n_nationkey / 100 END AS Latitude,
      CASE WHEN n_nationkey % 6 <> 5 THEN -84.0::double - n_nationkey / 100 END AS Longitude
      FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "subcorridors": """SELECT Zone AS Zone_Group, Corridor AS Zone, Subcorridor AS Corridor, SignalID, Name, Description, "Asof",
      Latitude, Longitude FROM corridors WHERE Subcorridor IS NOT NULL""",
    "inputs": "SELECT cast(n_nationkey as varchar) AS SignalID, cast(unnest(range(1, 9)) as int) AS Detector FROM nation",
    "det_config": """SELECT *, CASE WHEN CallPhase IN (2, 6) THEN 'Mainline' ELSE 'Side' END AS ApproachDesc, 'Vehicle' AS LaneTypeDesc
      FROM (SELECT SignalID, Detector, cast(((Detector - 1) // 2 + 1) * 2 as int) AS CallPhase, Detector % 4 AS CountPriority,
      cast(Detector * 0.5 as double) AS TimeFromStopBar, cast(Detector * 40 as double) AS DistanceFromStopBar,
      CASE Detector % 3 WHEN 0 THEN 'Advanced Count' WHEN 1 THEN 'Lane-by-lane Count' ELSE 'Stop Bar Presence' END AS DetectionTypeDesc,
      Detector % 3 + 1 AS LaneNumber FROM inputs)""",
    "ped_config": "SELECT SignalID, Detector, Detector AS CallPhase FROM inputs",
    "daily_measure": f"""SELECT *, {week('Date')} AS Week, {dow('Date')} AS DOW FROM (
      SELECT cast(o_custkey % 25 as varchar) AS SignalID, CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 6 END AS CallPhase,
      cast(o_orderdate as date) AS Date, cast(sum(cast(round(o_totalprice * 100) as bigint)) as double) / 1e7 AS value, count(*) AS weight
      FROM orders GROUP BY ALL)""",
    "hourly_measure": f"""SELECT *, cast(Date_Hour as date) AS Date, {week('cast(Date_Hour as date)')} AS Week, {dow('Date_Hour')} AS DOW FROM (
      SELECT cast(l_suppkey % 25 as varchar) AS SignalID, CASE WHEN l_orderkey % 2 = 0 THEN 2 ELSE 6 END AS CallPhase,
      l_shipdate + to_hours(l_linenumber * 3) AS Date_Hour, sum(l_quantity) AS value, count(*) AS weight FROM lineitem GROUP BY ALL)""",
    "segment_readings": """SELECT cast(l_suppkey as varchar) AS tmc_code, 'GROUP_' || (n_regionkey % 2) AS Zone_Group,
      'ZONE_' || (n_regionkey % 2) AS Zone, r_name AS Corridor, r_name || '-' || (n_nationkey // 5 % 2) AS Subcorridor,
      l_shipdate + to_hours(l_linenumber * 3) AS Hour, l_quantity / 10 AS miles, 45.0::double AS reference_speed,
      45.0::double * (1 - 3 * l_discount) AS speed, l_quantity / 10 / (45.0::double * (1 - 3 * l_discount)) * 60 AS travel_time_minutes,
      l_quantity / 10 / 45.0::double * 60 AS reference_minutes
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey""",
    "errors": """SELECT cast(user_id % 25 as varchar) AS SignalID, cast(ts as date) AS Date, ts, value,
      cast(regexp_extract(props, '([0-9]+)', 1) as int) AS k FROM events WHERE event_type = 'error'""",
    "comm_quality": """SELECT SignalID AS AssetNum, least(100.0::double, value) AS AvgQuality,
      Date - CASE WHEN k % 10 = 0 THEN 1 ELSE 0 END AS CSDATE, Date FROM errors""",
    "watchdog_messages": """SELECT ts AS TimeStamp, SignalID, SignalID || (k % 8 + 1) AS DetectorID, k % 8 + 1 AS Phase,
      ['Force Offs', 'Count', 'Max Outs', 'Pedestrian Activations', 'Missing Records'][k % 5 + 1] || ' threshold exceeded' AS Message
      FROM errors""",
    "alerts": """SELECT e.SignalID, k % 8 + 1 AS CallPhase, k % 8 + 1 AS Detector, Date,
      ['Bad Vehicle Detection', 'Bad Ped Detection', 'Bad Comm', 'Count', 'Missing Records'][k % 5 + 1] AS Alert,
      'Mainline' AS ApproachDesc, Zone_Group, Zone, Corridor, Name FROM errors e JOIN corridors USING (SignalID)""",
    # Counts.
    "counts_1h": f"""SELECT n.SignalID, Timeperiod, n.Detector, CallPhase, vol FROM (SELECT SignalID, {hour('Timestamp')} AS Timeperiod,
      EventParam AS Detector, cast(count(*) as int) AS vol FROM event_log WHERE EventCode = 82 GROUP BY ALL) n
      LEFT JOIN det_config k ON n.SignalID = k.SignalID AND n.Detector = k.Detector""",
    "counts_15": f"""SELECT n.SignalID, Timeperiod, n.Detector, CallPhase, vol FROM (SELECT SignalID, {quarter_hour('Timestamp')} AS Timeperiod,
      EventParam AS Detector, cast(count(*) as int) AS vol FROM event_log WHERE EventCode = 82 GROUP BY ALL) n
      LEFT JOIN det_config k ON n.SignalID = k.SignalID AND n.Detector = k.Detector""",
    "counts_ped_1h": f"""SELECT n.SignalID, Timeperiod, n.Detector, CallPhase, vol FROM (SELECT SignalID, {hour('Timestamp')} AS Timeperiod,
      EventParam AS Detector, cast(count(*) as int) AS vol FROM event_log WHERE EventCode = 90 GROUP BY ALL) n
      LEFT JOIN ped_config k ON n.SignalID = k.SignalID AND n.Detector = k.Detector""",
    "counts_ped_15": f"""SELECT n.SignalID, Timeperiod, n.Detector, CallPhase, vol FROM (SELECT SignalID, {quarter_hour('Timestamp')} AS Timeperiod,
      EventParam AS Detector, cast(count(*) as int) AS vol FROM event_log WHERE EventCode = 90 GROUP BY ALL) n
      LEFT JOIN ped_config k ON n.SignalID = k.SignalID AND n.Detector = k.Detector""",
    "filtered_1h": filtered("counts_1h", "det_config", 60, (1, 2, 1, 2, 12, 5)),
    "filtered_15": filtered("counts_15", "det_config", 15, (1, 2, 1, 2, 50, 20)),
    "adjusted_1h": adjusted("filtered_1h"),
    "filtered_sel": """SELECT f.* FROM filtered_1h f SEMI JOIN (SELECT * FROM (SELECT *, min(CountPriority) OVER
      (PARTITION BY SignalID, CallPhase) AS least FROM det_config) WHERE CountPriority = least) k
      ON f.SignalID = k.SignalID AND f.Detector = k.Detector AND f.CallPhase = k.CallPhase""",
    "adjusted_sel": adjusted("filtered_sel"),
    # Events.
    "cycle_starts": """SELECT DISTINCT SignalID, Date, Timestamp AS CycleStart FROM event_log_day
      WHERE EventCode = 31 AND EventParam = 1""",
    "green_pairs": pairs("event_log_day", 1, 8),
    "yellow_pairs": pairs("event_log_day", 8, 9),
    "red_pairs": pairs("event_log_day", 9, 1),
    "gyr": f"""SELECT p.SignalID, p.Date, p.EventParam AS Phase, c.CycleStart, p.StartTimeStamp, p.EndTimeStamp, p.EventCode, p.Duration,
      {secs('c.CycleStart', 'p.StartTimeStamp')} AS TimeInCycle
      FROM (SELECT * FROM green_pairs UNION ALL SELECT * FROM yellow_pairs UNION ALL SELECT * FROM red_pairs) p
      ASOF JOIN cycle_starts c ON p.SignalID = c.SignalID AND p.Date = c.Date AND p.StartTimeStamp >= c.CycleStart""",
    "count_config": """SELECT *, CountPriority = min(CountPriority) OVER (PARTITION BY SignalID, CallPhase) AS CountDetector FROM det_config""",
    "det_pairs_raw": pairs("event_log_day", 82, 81),
    "det_pairs": f"""SELECT p.SignalID, p.Date, k.CallPhase AS Phase, p.EventParam AS Detector,
      {plus('p.StartTimeStamp', 'k.TimeFromStopBar')} AS DetTimeStamp, p.Duration AS DetDuration, k.CountDetector
      FROM det_pairs_raw p JOIN count_config k ON p.SignalID = k.SignalID AND p.EventParam = k.Detector""",
    "attributed": f"""SELECT d.*, g.CycleStart, g.StartTimeStamp AS PhaseStart, g.EventCode,
      {secs('g.CycleStart', 'd.DetTimeStamp')} AS DetTimeInCycle, {secs('g.StartTimeStamp', 'd.DetTimeStamp')} AS DetTimeInPhase
      FROM det_pairs d ASOF JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY SignalID, Phase, Date, StartTimeStamp
        ORDER BY CycleStart DESC, EventCode DESC) AS rn FROM gyr) WHERE rn = 1) g
      ON d.SignalID = g.SignalID AND d.Phase = g.Phase AND d.Date = g.Date AND d.DetTimeStamp >= g.StartTimeStamp""",
    "volumes": """SELECT SignalID, Date, Phase, EventCode, PhaseStart, count(*) AS Volume FROM attributed WHERE CountDetector GROUP BY ALL""",
    "cycles": """SELECT g.SignalID, g.Date, g.Phase, g.CycleStart, g.StartTimeStamp AS PhaseStart, g.EndTimeStamp AS PhaseEnd, g.EventCode,
      coalesce(t.EventCode, 0) AS TermType, g.Duration, coalesce(v.Volume, 0) AS Volume FROM gyr g
      LEFT JOIN volumes v ON g.SignalID = v.SignalID AND g.Date = v.Date AND g.Phase = v.Phase AND g.EventCode = v.EventCode
        AND g.StartTimeStamp = v.PhaseStart
      LEFT JOIN (SELECT * FROM event_log_day WHERE EventCode IN (4, 5, 6)) t ON t.SignalID = g.SignalID AND t.EventParam = g.Phase
        AND t.Timestamp = g.EndTimeStamp AND t.Date = g.Date""",
    "detections": """SELECT SignalID, Date, Phase, Detector, CycleStart, PhaseStart, EventCode, DetTimeStamp, DetDuration, DetTimeInCycle,
      DetTimeInPhase FROM attributed""",
}

VIEWS["filtered_sel_15"] = VIEWS["filtered_sel"].replace("filtered_1h", "filtered_15")
VIEWS["adjusted_sel_15"] = adjusted("filtered_sel_15")


def with_views(body: str) -> str:
    """A statement with the views it needs, in order of dependence."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in VIEWS:
            if name not in order and re.search(rf"\b{name}\b", text):
                need(VIEWS[name])
                if name not in order:
                    order.append(name)

    need(body)
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in order)
    return f"WITH {ctes}\n{body}" if ctes else body
