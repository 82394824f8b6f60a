"""Reads of published measures (Q01-Q21), stored tables (S01-S30) and packages."""

import uuid

from pyspark.sql import functions as F

from checks.q_counts import LOW_HOURLY
from checks.q_rollups import MO_COR, VPH, _hours, monthly_avg, monthly_corridors, signal_rows, vph, weekly_avg
from checks.registry import query
from checks.views_sql import delta, dow, plus, rollup
from phasewright.functions.calendar import month_of
from phasewright.functions.stats import with_delta
from phasewright.operators import counts as C
from phasewright.operators import rollups as A
from phasewright.operators import serving as Q
from phasewright.plans.packages import Bundle
from phasewright.schemas import Metric, Target
from phasewright.session import new_path, stage
from phasewright.sources import tables as S
from phasewright.sources.publishing import publication, publish_bundle, write_aggregations

METRIC = Metric("Value", "value", "m", weight="weight", hourly_table="mh")
WK_COR = rollup("(" + weekly_avg("daily_measure") + ")", "Date", "value", "weight")
SIG_MO = signal_rows(monthly_avg("daily_measure"), MO_COR, "Month", "value")
HR_COR = rollup("(SELECT SignalID, Date_Hour AS Hour, value, weight FROM hourly_measure)", "Hour", "value", "weight", keep=True)
MONTH = "1998-06-01"


def weekly_corridors(v):
    return A.corridor_by_date(A.weekly_avg(v.daily_measure(), "value", "weight", peak_only=False), v.corridors(), "value", "weight")


def reader(v):
    """Published tables by name, as plans."""
    frames = {
        "cor_mo_m": lambda: monthly_corridors(v),
        "cor_wk_m": lambda: weekly_corridors(v),
        "cor_qu_m": lambda: A.quarterly(monthly_corridors(v), "value", "weight"),
        "sig_mo_m": lambda: A.signal_rows(A.monthly_avg(v.daily_measure(), "value", "weight"), monthly_corridors(v), v.corridors()),
        "cor_mo_mh": lambda: A.corridor_by_hour(_hours(v), v.corridors(), "value", "weight"),
    }
    return lambda name: frames[name]()


MO_COLS = "Zone_Group, Corridor, Month, ~value, weight:bigint, ~delta"


@query(
    "q01_merge_recomputed", MO_COLS,
    f"""SELECT *, {delta('value', 'Zone_Group, Corridor', 'Month')} AS delta FROM (SELECT * EXCLUDE (delta) FROM ({MO_COR}) WHERE Month >= date '1996-01-01' AND Month < date '1999-01-01'
    UNION ALL SELECT Zone_Group, Corridor, Month, value * 2, weight FROM ({MO_COR}) WHERE Month >= date '1999-01-01')""",
)
def _(v):
    mo = monthly_corridors(v)
    new = mo.withColumn("value", F.col("value") * 2)
    d = [F.lit(x).cast("date") for x in ("1996-01-01", "1999-01-01")]
    return Q.merge_recomputed(mo, new, "value", "Month", *d)


@query("q02_query_month_upto", MO_COLS, f"SELECT * FROM ({MO_COR}) WHERE Zone_Group = 'GROUP_0' AND Month <= date '{MONTH}'")
def _(v):
    return Q.query_metric(reader(v), METRIC, zone_group="GROUP_0", month=MONTH)


@query(
    "q02_query_week_corridor", "Zone_Group, Corridor, Date, ~value, ~delta",
    f"SELECT * FROM ({WK_COR}) WHERE Zone_Group = 'ZONE_0' AND Corridor = 'ASIA' AND Date <= date '1998-06-30'",
)
def _(v):
    return Q.query_metric(reader(v), METRIC, resolution="weekly", zone_group="ZONE_0", corridor="ASIA", month=MONTH)


@query(
    "q02_query_hours_of_month", "Zone_Group, Corridor, Hour, ~value, ~delta",
    f"SELECT * FROM ({HR_COR}) WHERE Zone_Group = 'GROUP_0' AND Hour >= timestamp '1998-06-01' AND Hour <= timestamp '1998-06-30 23:00:00'",
)
def _(v):
    return Q.query_metric(reader(v), METRIC, hourly=True, zone_group="GROUP_0", month=MONTH, upto=False)


@query("q02_query_all_signals", "Zone_Group, Corridor, Month, ~value, ~delta", f"SELECT * FROM ({SIG_MO}) WHERE Month = date '{MONTH}'")
def _(v):
    return Q.query_metric(reader(v), METRIC, level="signal", zone_group="All", month=MONTH, upto=False)


BA = """SELECT Corridor, coalesce(n.Description, Corridor) AS Description, avg({v}) FILTER (WHERE Date <= date '1997-06-30') AS before,
  avg({v}) FILTER (WHERE Date >= date '1998-01-01') AS after FROM ({src}) LEFT JOIN (SELECT SignalID, min(Description) AS Description FROM corridors GROUP BY ALL) n ON Corridor = n.SignalID
  WHERE Zone_Group = 'ZONE_0' AND Date >= date '1997-01-01' AND Date < date '1998-07-01' AND (Date <= date '1997-06-30' OR Date >= date '1998-01-01') GROUP BY ALL"""
WINDOWS = (("1997-01-01", "1997-06-30"), ("1998-01-01", "1998-06-30"))


@query(
    "q03_before_after", "Corridor, Description, ~before, ~after, ~delta",
    f"SELECT *, (after - before) / nullif(before, 0) AS delta FROM ({BA.format(v='value', src=WK_COR)})",
)
def _(v):
    return Q.before_after(weekly_corridors(v), "value", v.corridors(), "ZONE_0", *WINDOWS)


@query(
    "q04_before_after_scatter", "Corridor, Description, ~before_x, ~after_x, ~before_y, ~after_y",
    f"""SELECT Corridor, Description, x.before AS before_x, x.after AS after_x, y.before AS before_y, y.after AS after_y FROM ({BA.format(v='value', src=WK_COR)}) x
    FULL JOIN ({BA.format(v='weight', src=WK_COR)}) y USING (Corridor, Description)""",
)
def _(v):
    wk = weekly_corridors(v)
    x = Q.before_after(wk, "value", v.corridors(), "ZONE_0", *WINDOWS)
    return Q.before_after_scatter(x, Q.before_after(wk, "weight", v.corridors(), "ZONE_0", *WINDOWS))


_SUMS = f"(SELECT * FROM ({rollup('(' + monthly_avg('daily_measure', w=None) + ')', 'Month', 'value')}))"
SUMMARY = f"""SELECT Zone_Group, Corridor, Month, a.value AS aog, a.delta AS aog_delta, t.value AS tp, t.delta AS tp_delta FROM ({MO_COR}) a LEFT JOIN {_SUMS} t
  USING (Zone_Group, Corridor, Month)"""


def summary(v):
    sums = A.corridor_by_month(A.monthly_avg(v.daily_measure(), "value"), v.corridors(), "value")
    return Q.corridor_summary({"aog": (monthly_corridors(v), "value"), "tp": (sums, "value")})


@query("q05_corridor_summary", "Zone_Group, Corridor, Month, ~aog, ~aog_delta, ~tp, ~tp_delta", SUMMARY)
def _(v):
    return summary(v)


_CELL = """SELECT Corridor, '{m}' AS Metric, {m} AS value, {m}_delta AS delta, {g} AS goal, CASE WHEN {c} {s} {g} THEN 'Meeting Goal' WHEN NOT ({c} {s} {g})
  THEN 'Not Meeting Goal' END AS check_goal, CASE WHEN {m}_delta {s} 0 THEN 'Improvement' WHEN NOT ({m}_delta {s} 0) THEN 'Deterioration' END AS check_delta
  FROM ({src}) WHERE Month = date '1998-06-01' AND Zone_Group = 'ZONE_0'"""
GOALS = {"aog": (2.5, ">"), "tp": (0.0, ">")}


@query(
    "q06_summary_with_goals", "Corridor, Metric, ~value, ~delta, ~goal, check_goal, check_delta",
    _CELL.format(m="aog", g="2.5", c="aog", s=">=", src=SUMMARY) + " UNION ALL " + _CELL.format(m="tp", g="0.0", c="tp_delta", s=">=", src=SUMMARY),
)
def _(v):
    return Q.summary_with_goals(summary(v), MONTH, "ZONE_0", GOALS)


@query(
    "q06_pivot_corridors", "Metric, ~AFRICA, ~ASIA, ~EUROPE",
    """SELECT Metric, max(value) FILTER (WHERE Corridor = 'AFRICA') AS "AFRICA", max(value) FILTER (WHERE Corridor = 'ASIA') AS "ASIA",
    max(value) FILTER (WHERE Corridor = 'EUROPE') AS "EUROPE" FROM ({}) GROUP BY ALL""".format(
        _CELL.format(m="aog", g="2.5", c="aog", s=">=", src=SUMMARY) + " UNION ALL " + _CELL.format(m="tp", g="0.0", c="tp_delta", s=">=", src=SUMMARY)
    ),
)
def _(v):
    return Q.pivot_corridors(Q.summary_with_goals(summary(v), MONTH, "ZONE_0", GOALS), "value", ["AFRICA", "ASIA", "EUROPE"])


@query(
    "q07_value_box", "Zone_Group, Corridor, ~value, ~delta",
    f"SELECT Zone_Group, Corridor, value, coalesce(delta, 0) AS delta FROM ({MO_COR}) WHERE Zone_Group = 'GROUP_0' AND Corridor = Zone_Group AND Month = date '{MONTH}'",
)
def _(v):
    return Q.value_box(reader(v), METRIC, "GROUP_0", month=MONTH)


@query(
    "q07_value_box_quarter", "Zone_Group, Corridor, ~value",
    f"""SELECT Zone_Group, Corridor, sum(value * weight) / sum(weight) AS value FROM ({MO_COR}) WHERE Zone_Group = 'ZONE_1' AND Corridor = 'AMERICA'
    AND Month BETWEEN date '1998-04-01' AND date '1998-06-30' GROUP BY ALL""",
)
def _(v):
    return Q.value_box(reader(v), METRIC, "ZONE_1", corridor="AMERICA", quarter="1998.2")


@query(
    "q08_first_and_last", "Zone_Group, Corridor, first_month, ~first_value, last_month, ~last_value",
    f"""SELECT Zone_Group, Corridor, min(Month) AS first_month, arg_min(value, Month) AS first_value, max(Month) AS last_month, arg_max(value, Month) AS last_value
    FROM ({MO_COR}) WHERE Zone_Group = 'GROUP_1' AND Corridor = Zone_Group AND Month <= date '{MONTH}' GROUP BY ALL""",
)
def _(v):
    return Q.first_and_last(Q.monthly_series(reader(v), METRIC, "GROUP_1", MONTH), "value", ["Zone_Group", "Corridor"])


_AT = {"bar": f"Month = date '{MONTH}'", "line": "Date <= date '1998-06-30' AND value IS NOT NULL",
       "hours": "Hour >= timestamp '1998-06-01' AND Hour <= timestamp '1998-06-30 23:00:00'"}


@query(
    "q09_trend", "part, Corridor, ~value, is_average",
    " UNION ALL ".join(
        f"SELECT '{part}' AS part, Corridor, value, Corridor = 'GROUP_0' AS is_average FROM ({src}) WHERE Zone_Group = 'GROUP_0' AND {_AT[part]}"
        for part, src in (("bar", MO_COR), ("line", WK_COR), ("hours", HR_COR))
    ),
)
def _(v):
    parts = Q.trend(reader(v), METRIC, "GROUP_0", MONTH)
    return Q.reconstitute({k: d.select("Corridor", "value", "is_average") for k, d in parts.items()}, "part")


@query(
    "q10_completed_days", "SignalID, Date, weight:bigint",
    """SELECT g.SignalID, g.Date, coalesce(s.w, 0) AS weight FROM (SELECT SignalID, cast(unnest(generate_series(date_trunc('month', cast(lo as timestamp)), cast(last_day(hi) as timestamp), interval 1 day)) as date) AS Date
    FROM (SELECT DISTINCT SignalID FROM daily_measure), (SELECT min(Date) AS lo, max(Date) AS hi FROM daily_measure)) g
    LEFT JOIN (SELECT SignalID, Date, sum(weight) AS w FROM daily_measure GROUP BY ALL) s USING (SignalID, Date)""",
)
def _(v):
    return Q.completed_days(v.daily_measure(), "weight", ["SignalID"])


_DAYS = ["1998-06-01", "1998-06-02", "1998-06-03"]
_D = {d: d.replace("-", "_") for d in _DAYS}


def _renamed(df):
    return df.withColumnsRenamed({d: f"d{_D[d]}" for d in _DAYS})


@query(
    "q10_heat_map", "SignalID, " + ", ".join(f"d{_D[d]}:bigint" for d in _DAYS),
    "SELECT SignalID, " + ", ".join(f"coalesce(sum(weight) FILTER (WHERE Date = date '{d}'), 0) AS d{_D[d]}" for d in _DAYS) + " FROM daily_measure GROUP BY ALL",
)
def _(v):
    return _renamed(Q.heat_map(v.daily_measure(), "weight", ["SignalID"], _DAYS))


@query(
    "q11_status_matrix", "CameraID, Description, " + ", ".join(f"d{_D[d]}" for d in _DAYS),
    "SELECT CameraID, Description, " + ", ".join(
        f"""CASE coalesce(max(up) FILTER (WHERE Date = date '{d}'), 0) WHEN 0 THEN 'Camera Down' WHEN 1 THEN 'Working at encoder, but not 511'
        ELSE 'Working on 511' END AS d{_D[d]}""" for d in _DAYS
    ) + " FROM (SELECT SignalID AS CameraID, 'cam ' || SignalID AS Description, Date, weight % 3 AS up FROM daily_measure) GROUP BY ALL",
)
def _(v):
    d = v.daily_measure().groupBy(
        F.col("SignalID").alias("Corridor"), F.concat(F.lit("cam "), "SignalID").alias("Description"), "Date"
    ).agg(F.max(F.col("weight") % 3).alias("up"))
    return _renamed(Q.status_matrix(d, "GROUP_0", _DAYS))


_MH = "SELECT SignalID, Hour AS month_hour, cast(date_trunc('month', Hour) as date) AS Month, avg(value) AS value FROM (SELECT *, date_trunc('month', Date_Hour) + (Date_Hour - date_trunc('day', Date_Hour)) AS Hour FROM hourly_measure) GROUP BY ALL"


@query(
    "q12_compare_with_past", "SignalID, Month, month_hour, ~value, ~value_last_month, ~value_last_year",
    f"""WITH h AS ({_MH}) SELECT h.SignalID, h.Month, h.month_hour, h.value, m.value AS value_last_month, y.value AS value_last_year FROM h
    LEFT JOIN h m ON h.SignalID = m.SignalID AND h.month_hour = m.month_hour + interval 1 month LEFT JOIN h y ON h.SignalID = y.SignalID AND h.month_hour = y.month_hour + interval 1 year""",
)
def _(v):
    h = A.monthly_by_hour(_hours(v), "value", change=False).withColumnRenamed("Hour", "month_hour").withColumn("Month", month_of("month_hour"))
    return Q.compare_with_past(h, "value", ["SignalID"])


_VERSIONS = """SELECT o_orderkey, cast(date_trunc('month', o_orderdate) as date) AS Month, 'ZONE_' || (o_custkey % 7) AS Zone, o_orderdate AS LastModified FROM orders"""


def versions(v):
    return v.table("orders").select(
        "o_orderkey", month_of("o_orderdate").alias("Month"), F.concat(F.lit("ZONE_"), F.col("o_custkey") % 7).alias("Zone"), F.col("o_orderdate").alias("LastModified")
    )


@query(
    "q13_last_modified", "o_orderkey, Month, Zone, LastModified",
    f"SELECT * FROM (SELECT *, max(LastModified) OVER (PARTITION BY Month, Zone) AS m FROM ({_VERSIONS})) WHERE LastModified = m",
)
def _(v):
    return Q.last_modified(versions(v))


@query(
    "q14_latest_versions", "o_orderkey, Month, Zone, LastModified",
    f"SELECT * FROM (SELECT *, rank() OVER (PARTITION BY Month, Zone ORDER BY LastModified DESC) AS r FROM ({_VERSIONS})) WHERE r <= 10",
)
def _(v):
    return Q.latest_versions(versions(v))


@query(
    "q15_published_range", MO_COLS, f"SELECT * FROM ({MO_COR}) WHERE Month BETWEEN date '1997-01-01' AND date '{MONTH}' AND Corridor = 'GROUP_0'",
)
def _(v):
    d = [F.lit(x).cast("date") for x in ("1997-01-01", MONTH)]
    return Q.published_range(monthly_corridors(v), "Month", *d, "GROUP_0")


@query(
    "q16_signal_counts", "SignalID, Detector:int, CallPhase:int, Timeperiod, ~vol",
    "SELECT SignalID, Detector, CallPhase, Timeperiod, coalesce(vol, 0) AS vol FROM filtered_1h WHERE SignalID = '7' AND Date BETWEEN date '2024-01-03' AND date '2024-01-20'",
)
def _(v):
    f = C.filter_counts(C.counts(v.event_log(), v.det_config()), v.det_config(), LOW_HOURLY)
    return Q.signal_counts(f, "7", "2024-01-03", "2024-01-20")


@query(
    "q17_signal_series", "SignalID, CallPhase:int, Date_Hour, ~value",
    """WITH r AS (SELECT SignalID, CallPhase, Date_Hour, value FROM hourly_measure WHERE SignalID = '3' AND date_trunc('month', Date_Hour) = date '1998-06-01')
    SELECT g.SignalID, g.CallPhase, g.h AS Date_Hour, coalesce(r.value, 0) AS value FROM (SELECT SignalID, CallPhase, unnest(generate_series(lo, hi, interval 1 hour)) AS h
    FROM (SELECT DISTINCT SignalID, CallPhase FROM r), (SELECT min(Date_Hour) AS lo, max(Date_Hour) AS hi FROM r)) g LEFT JOIN r ON g.SignalID = r.SignalID AND g.CallPhase = r.CallPhase AND g.h = r.Date_Hour""",
)
def _(v):
    return Q.signal_series(v.hourly_measure(), "3", "value", MONTH, period="Date_Hour")


_MAP = f"""SELECT s.Corridor AS SignalID, c.Description, s.Zone_Group, s.value, c.Latitude, c.Longitude FROM ({SIG_MO}) s JOIN corridors c ON s.Corridor = c.SignalID
  WHERE Month = date '{MONTH}' AND c.Latitude IS NOT NULL"""


@query("q18_map_table", "SignalID, Description, Zone_Group, ~value, ~Latitude, ~Longitude", _MAP)
def _(v):
    return Q.map_table(reader(v), METRIC, MONTH, v.corridors())


@query("q19_ranked_signals", "SignalID, Signal, Corridor, ~value", f"SELECT DISTINCT SignalID, Description AS Signal, Zone_Group AS Corridor, value FROM ({_MAP})")
def _(v):
    return Q.ranked_signals(Q.map_table(reader(v), METRIC, MONTH, v.corridors()), METRIC)


@query(
    "q20_reconstitute", "SignalID, Date, weight:bigint, phase",
    "SELECT SignalID, Date, weight, 'p' || CallPhase AS phase FROM daily_measure",
)
def _(v):
    d = v.daily_measure().select("SignalID", "CallPhase", "Date", "weight")
    return Q.reconstitute({f"p{p}": d.where(F.col("CallPhase") == p) for p in (2, 6)}, "phase")


@query(
    "q21_compare_frames", "SignalID, Date, weight:bigint, only_in",
    """(SELECT SignalID, Date, weight, 'first' AS only_in FROM (SELECT SignalID, Date, weight FROM daily_measure WHERE CallPhase = 2 EXCEPT ALL SELECT SignalID, Date, weight FROM daily_measure WHERE CallPhase = 6))
    UNION ALL (SELECT SignalID, Date, weight, 'second' FROM (SELECT SignalID, Date, weight FROM daily_measure WHERE CallPhase = 6 EXCEPT ALL SELECT SignalID, Date, weight FROM daily_measure WHERE CallPhase = 2))""",
)
def _(v):
    d = v.daily_measure()
    c = ["SignalID", "Date", "weight"]
    return Q.compare_frames(d.where("CallPhase = 2").select(*c), d.where("CallPhase = 6").select(*c))


# Stored tables --------------------------------------------------------------------------------


def _path(v, name: str) -> str:
    return new_path(v.spark, name)


def _database(v) -> str:
    """A database of the query's own in the shared folder."""
    name = f"checks_{uuid.uuid4().hex}"
    v.spark.sql(f"CREATE DATABASE {name} LOCATION '{_path(v, 'db')}'")
    return name


LOG_COLS = "SignalID, Timestamp, EventCode:int, EventParam:int, Date"


@query("s01_event_log", LOG_COLS, "SELECT DISTINCT * FROM event_log WHERE Date BETWEEN date '2024-01-05' AND date '2024-01-20'")
def _(v):
    return S.event_log(v.event_log(), "2024-01-05", "2024-01-20")


@query(
    "s02_read_stored_events", LOG_COLS,
    f"SELECT DISTINCT * FROM event_log WHERE Date BETWEEN date '2024-01-05' AND date '2024-01-20' AND {dow('Date')} IN (3, 4, 5) AND SignalID IN ('3', '7', '11')",
)
def _(v):
    path = _path(v, "events")
    S.write_days(v.event_log(), path)
    return S.read_table(v.spark, path, start="2024-01-05", end="2024-01-20", signals=["3", "7", "11"], midweek_only=True, distinct=True)


@query("s03_read_cycle_data", "SignalID, Phase:int, CycleStart, PhaseStart, PhaseEnd, EventCode:int, Date", "SELECT * FROM cycles WHERE Phase IN (3, 4, 7, 8)")
def _(v):
    return S.cycle_data(v.stored_tables()[1], lambda d: d.where(F.col("Phase").isin(3, 4, 7, 8)))


@query("s03_stored_cycles", "SignalID, Phase:int, CycleStart, PhaseStart, PhaseEnd, EventCode:int, Date", "SELECT * FROM cycles")
def _(v):
    path = _path(v, "cycles")
    S.write_days(v.stored_tables()[1], path)
    return S.cycle_data(S.read_table(v.spark, path))


@query(
    "s04_stored_detections", "SignalID, Phase:int, Detector:int, CycleStart, PhaseStart, EventCode:int, DetTimeStamp, ~DetDuration, Date",
    "SELECT * FROM detections",
)
def _(v):
    path = _path(v, "detections")
    S.write_days(v.stored_tables()[2], path)
    return S.read_table(v.spark, path)


@query(
    "s07_stored_configuration", "SignalID, Detector:int, CallPhase:int, Date",
    "SELECT SignalID, Detector, CallPhase, unnest([date '2024-01-02', date '2024-01-03']) AS Date FROM det_config",
)
def _(v):
    config = v.det_config().select("SignalID", "Detector", "CallPhase")
    days = F.sequence(F.lit("2024-01-01").cast("date"), F.lit("2024-01-03").cast("date"))
    path = _path(v, "config")
    S.write_days(config.withColumn("Date", F.explode(days)), f"{path}/detectors")
    return S.config_reader(v.spark, path, "detectors", config.schema)("2024-01-02", "2024-01-03")


@query(
    "s05_detection_events", "SignalID, Phase:int, Detector:int, CycleStart, PhaseStart, DetOn, DetOff, ~DetDuration, Date",
    f"SELECT *, DetTimeStamp AS DetOn, {plus('DetTimeStamp', 'DetDuration')} AS DetOff FROM detections WHERE Detector <= 4",
)
def _(v):
    return S.detection_events(v.stored_tables()[2], lambda d: d.where("Detector <= 4"))


@query(
    "s11_s20_rewrite_days", "Date, rows:bigint, codes:bigint",
    """SELECT Date, count(*) AS rows, sum(CASE WHEN Date >= date '2024-01-20' THEN EventCode + 1000 ELSE EventCode END) AS codes FROM event_log GROUP BY ALL""",
)
def _(v):
    # The last days are written again with other codes: they are replaced, the others stay.
    path = _path(v, "days")
    S.write_days(v.event_log(), path)
    S.write_days(v.event_log().where("Date >= date'2024-01-20'").withColumn("EventCode", F.col("EventCode") + 1000), path)
    return S.read_table(v.spark, path).groupBy("Date").agg(F.count("*").alias("rows"), F.sum("EventCode").alias("codes"))


@query("s12_split_by_period_date", "SignalID, Hour, Date, vph:bigint", f"SELECT SignalID, Hour, cast(Hour as date) AS Date, vph FROM {VPH}")
def _(v):
    path = _path(v, "vph")
    S.write_days(S.with_day(vph(v), "Hour"), path)
    return S.read_table(v.spark, path)


@query(
    "s14_millisecond_parquet", "event_id, ts",
    "SELECT event_id, make_timestamp((epoch_us(ts) + 500) // 1000 * 1000) AS ts FROM events",
)
def _(v):
    path = _path(v, "ms")
    S.write_parquet(v.table("events").select("event_id", "ts"), path)
    return v.spark.read.parquet(path)


@query("s14_csv_round_trip", "o_orderkey, o_orderstatus, ~o_totalprice", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def _(v):
    path = _path(v, "csv")
    S.write_csv(v.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path)
    return v.spark.read.schema("o_orderkey bigint, o_orderstatus string, o_totalprice double").option("header", True).csv(path)


@query("s17_read_one_signal", LOG_COLS, "SELECT * FROM event_log WHERE SignalID = '5' AND Date IN (date '2024-01-09', date '2024-01-10')")
def _(v):
    path = _path(v, "one")
    S.write_days(v.event_log(), path)
    return S.read_table(v.spark, path, start="2024-01-09", end="2024-01-10", signals=["5"])


@query(
    "s21_publish_window", MO_COLS,
    f"""SELECT * FROM ({MO_COR}) WHERE Month >= date '1996-01-01' AND Month < date '1999-01-01' UNION ALL
    SELECT Zone_Group, Corridor, Month, value * 2, weight, delta FROM ({MO_COR}) WHERE Month >= date '1999-01-01' AND Month < date '2000-02-01'""",
)
def _(v):
    mo = monthly_corridors(v)
    return S.publish_window(mo, mo.withColumn("value", F.col("value") * 2), "Month", start="1999-01-01", report_start="1996-01-01", report_end="2000-01-01")


@query(
    "s23_replace_from_first", MO_COLS,
    f"""SELECT * FROM ({MO_COR}) WHERE Month < date '1999-03-01' UNION ALL SELECT Zone_Group, Corridor, Month, value * 3, weight, delta FROM ({MO_COR}) WHERE Month >= date '1999-03-01'""",
)
def _(v):
    mo = monthly_corridors(v)
    asof = F.lit("1999-03-01").cast("date")
    return S.replace_from_first(mo, mo.withColumn("value", F.col("value") * 3), "Month", asof)




@query(
    "s22_s25_publish_bundle", "Zone_Group, Corridor, Month, ~value",
    f"""SELECT Zone_Group, Corridor, Month, value FROM ({MO_COR}) WHERE Month < date '1999-01-01' UNION ALL
    SELECT Zone_Group, Corridor, Month, value * 2 FROM ({MO_COR}) WHERE Month >= date '1999-01-01'""",
)
def _(v):
    prefix = _database(v) + "."
    mo = monthly_corridors(v)
    target = {"cor_mo_m": Target("Month", variable="value")}
    publish_bundle(v.spark, Bundle({"cor_mo_m": lambda: mo}, target), prefix=prefix)
    publish_bundle(v.spark, Bundle({"cor_mo_m": lambda: mo.withColumn("value", F.col("value") * 2)}, target), prefix=prefix, start="1999-01-01")
    return v.spark.table(f"{prefix}cor_mo_m")


@query(
    "s26_merge_then_publish", "Zone_Group, Corridor, Month, ~value, ~delta, version:int",
    f"""SELECT Zone_Group, Corridor, Month, value, {delta('value', 'Zone_Group, Corridor', 'Month')} AS delta,
    CASE WHEN Month >= date '2000-03-01' AND Month <= date '2000-09-01' THEN 2 ELSE 1 END AS version
    FROM (SELECT Zone_Group, Corridor, Month, CASE WHEN Month BETWEEN date '2000-03-01' AND date '2000-08-01' THEN value * 2 ELSE value END AS value
    FROM ({MO_COR})) WHERE Month >= date '1996-01-01' AND Month < date '2001-01-01'""",
)
def _(v):
    # Two rounds over the stored aggregate: the second recomputes from 2000 on, and only some months come out different.
    prefix = _database(v) + "."
    stored = stage(monthly_corridors(v).select("Zone_Group", "Corridor", "Month", "value", "delta"))
    target = {"cor_mo_m": Target("Month", variable="value")}
    window = {"report_start": "1996-01-01", "report_end": "2000-12-01", "prefix": prefix}
    first = stored.where("Month >= date'1996-01-01'")
    first = with_delta(first.drop("delta"), "value", ["Zone_Group", "Corridor"], "Month")
    write_aggregations(v.spark, Bundle({"cor_mo_m": lambda: first}, target), calc_start="1996-01-01", **window)
    other = F.when(F.col("Month").between("2000-03-01", "2000-08-01"), F.col("value") * 2).otherwise(F.col("value"))
    again = stored.where("Month >= date'2000-01-01'").withColumn("value", other)
    write_aggregations(v.spark, Bundle({"cor_mo_m": lambda: again}, target), calc_start="2000-01-01", **window)
    versions = publication(v.spark, f"{prefix}cor_mo_m").parts
    of = F.create_map(*[F.lit(x) for pair in versions.items() for x in pair])
    return v.spark.table(f"{prefix}cor_mo_m").withColumn("version", of[F.date_format("Month", "yyyy-MM")])


@query(
    "s24_load_once", MO_COLS, f"SELECT * FROM ({MO_COR}) WHERE Month BETWEEN date '1996-01-01' AND date '1998-12-01'",
)
def _(v):
    name = f"{_database(v)}.once"
    S.load_once(monthly_corridors(v), name, period="Month", start="1996-01-01", end="1998-12-01")
    return v.spark.table(name)


@query(
    "s27_key_value", "key, parts:bigint, s_suppkey, s_name",
    "SELECT 'suppliers' AS key, 1 AS parts, s_suppkey, s_name FROM supplier",
)
def _(v):
    kv = S.key_value("suppliers", v.table("supplier").select("s_suppkey", "s_name"))
    rows = kv.select("key", F.explode(F.from_json("data", "array<struct<s_suppkey: bigint, s_name: string>>")).alias("r"))
    return rows.select("key", "r.*").join(kv.groupBy("key").agg(F.count("*").alias("parts")), "key")


_DETAILS = """SELECT coalesce(r.Timeperiod, f.Timeperiod, a.Timeperiod) AS Timeperiod, coalesce(r.SignalID, f.SignalID, a.SignalID) AS SignalID,
  coalesce(r.Detector, f.Detector, a.Detector) AS Detector, coalesce(r.CallPhase, f.CallPhase, a.CallPhase, 0) AS CallPhase, r.vol AS vol_rc,
  CASE WHEN f.Good_Day = 0 THEN a.vol END AS vol_ac, f.Good_Day = 0 AS bad_day FROM counts_1h r
  FULL JOIN filtered_1h f ON r.SignalID = f.SignalID AND r.Timeperiod = f.Timeperiod AND r.Detector = f.Detector AND r.CallPhase = f.CallPhase
  FULL JOIN adjusted_1h a ON f.SignalID = a.SignalID AND f.Timeperiod = a.Timeperiod AND f.Detector = a.Detector AND f.CallPhase = a.CallPhase"""


def details(v):
    counted = stage(C.counts(v.event_log(), v.det_config()))
    filtered = stage(C.filter_counts(counted, v.det_config(), LOW_HOURLY))
    return S.signal_details(counted, filtered, C.adjust_counts(filtered))


@query(
    "s28_signal_details", "SignalID, Date, items:int, ~vol_rc, ~vol_ac",
    f"SELECT SignalID, cast(Timeperiod as date) AS Date, count(*) AS items, sum(vol_rc) AS vol_rc, sum(vol_ac) AS vol_ac FROM ({_DETAILS}) GROUP BY ALL",
)
def _(v):
    rows = details(v).select("SignalID", "Date", F.size("data").alias("items"), F.inline("data"))
    return rows.groupBy("SignalID", "Date", "items").agg(F.sum("vol_rc").alias("vol_rc"), F.sum("vol_ac").alias("vol_ac"))


# All rows first: a filter pushed into the full joins sends some engines to a plan that does not end.
_ALL_DETAILS = f"WITH all_details AS MATERIALIZED ({_DETAILS})"


def _stored_details(v):
    table = f"{_database(v)}.signal_details"
    S.store_signal_details(details(v), table, buckets=8)
    return v.spark.table(table)


@query("s28_detail_rows", "Timeperiod, SignalID, Detector:int, CallPhase:int, vol_rc:int, vol_ac:int, bad_day", f"{_ALL_DETAILS} SELECT * FROM all_details")
def _(v):
    return S.read_signal_details(_stored_details(v))


@query(
    "s29_read_signal_details", "Timeperiod, SignalID, Detector:int, CallPhase:int, vol_rc:int, vol_ac:int, bad_day",
    f"{_ALL_DETAILS} SELECT * FROM all_details WHERE SignalID = '4' AND cast(Timeperiod as date) BETWEEN date '2024-01-02' AND date '2024-01-25'",
)
def _(v):
    return S.read_signal_details(_stored_details(v), "4", "2024-01-02", "2024-01-25")


@query(
    "s30_union_by_name", "SignalID, Date, weight:bigint, Hour",
    "SELECT SignalID, Date, weight, NULL::timestamp AS Hour FROM daily_measure UNION ALL SELECT SignalID, Date, weight, Date_Hour FROM hourly_measure",
)
def _(v):
    return S.union_by_name([
        v.daily_measure().select("SignalID", "Date", "weight"),
        v.hourly_measure().select("SignalID", "Date", "weight", F.col("Date_Hour").alias("Hour")),
    ])


@query(
    "s19_source_events", "SignalID, Timestamp, EventCode:int, EventParam:int",
    "SELECT SignalID, Timestamp, EventCode, EventParam FROM event_log WHERE Timestamp >= timestamp '2024-01-05' AND Timestamp < timestamp '2024-01-08'",
)
def _(v):
    # The slices a database read would use, applied to the stored log.
    return S.union_by_name([v.event_log().where(p) for p in S.time_predicates("2024-01-05", "2024-01-07", 4)])


