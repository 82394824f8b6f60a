"""Packages: the rollups each measure gets."""

import uuid

from pyspark.sql import functions as F

from checks.q_measures import _PED, _PED_UP, TINT_SQL, _papd, _paph
from checks.q_rollups import (
    _AGG_MO, _AGG_WK, _DAILY_P, AVG_DDU, DDU, HOURS, METRIC, _three, avg_by_hour, ddu, monthly_avg, monthly_by_hour, monthly_volume, period_avg, period_sum, quarterly,
    signal_rows, weekly_avg, weekly_by_hour, weekly_sum,
)
from checks.q_travel import GROUP, corridor_volumes, index_sql, with_shares
from checks.registry import query
from checks.views_sql import delta, dow, peak, rollup, week
from phasewright.functions import calendar as X
from phasewright.operators import counts as C
from phasewright.operators import detectors as K
from phasewright.operators import measures as M
from phasewright.operators import rollups as A
from phasewright.plans import packages as P
from phasewright.schemas import METRICS, Target
from phasewright.session import new_path, stage
from phasewright.sources.publishing import publish


def sub(sql: str) -> str:
    return f"({sql})"


def named(src: str, v: str, w: str, where: str = "") -> str:
    return f'(SELECT * RENAME (value AS {v}, weight AS "{w}") FROM {src} {where})'


def hours_as(v, var: str, wt: str):
    return v.hourly_measure().withColumnsRenamed({"value": var, "weight": wt})


WK = "Zone_Group, Corridor, Date, ~{v}, ~delta"
MO = "Zone_Group, Corridor, Month, ~{v}, ~delta"
HR = "Zone_Group, Corridor, Hour, ~{v}, ~delta"


@query("p01_detector_uptime_week", WK.format(v="uptime"), rollup(sub(weekly_avg(f"(SELECT *, {week('Date')} AS Week FROM ({DDU}))", "uptime", '"all"')), "Date", "uptime", '"all"'))
def _(v):
    return P.detector_uptime(stage(ddu(v).withColumn("Week", X.week("Date"))), v.corridors())["cor_wk_du"]


@query("p01_detector_uptime_day_subcorridor", "Zone_Group, Corridor, Date, ~uptime_sb, ~uptime_pr, ~uptime", _three("Date", f"({AVG_DDU})", False).replace("JOIN corridors h", "JOIN subcorridors h"))
def _(v):
    return P.detector_uptime(stage(ddu(v).withColumn("Week", X.week("Date"))), v.corridors())["sub_dy_du"]


_PAU = f"(SELECT SignalID, Detector AS CallPhase, Date, {week('Date')} AS Week, uptime, 1 AS ones FROM ({_PED_UP}))"


def _pau(v):
    return P.ped_uptime(_papd(v), _paph(v), v.corridors(), "2024-01-08", "2024-01-01", "2024-02-04")


@query("p02_ped_uptime_day", WK.format(v="uptime"), rollup(f"(SELECT SignalID, Date, uptime FROM ({period_avg(_PAU, 'Date', 'uptime', 'ones')}))", "Date", "uptime"))
def _(v):
    return _pau(v)["cor_dy_pau"]


@query(
    "p02_ped_counts_repaired", "SignalID, Detector:int, CallPhase:int, Date, papd:bigint",
    f"""SELECT SignalID, Detector, CallPhase, Date, CASE WHEN uptime = 0 THEN floor(avg(CASE WHEN uptime = 0 THEN NULL ELSE papd END) OVER
    (PARTITION BY SignalID, Detector, CallPhase, date_trunc('month', Date))) ELSE papd END AS papd FROM ({_PED_UP})""",
)
def _(v):
    return _pau(v)["papd_repaired"]


def _activations(v):
    papd = v.daily_measure().withColumnRenamed("value", "papd")
    paph = v.hourly_measure().withColumnRenamed("value", "paph").withColumn("Hour", F.col("Date_Hour"))
    return P.ped_activations(papd, paph, v.corridors())


_PAPD = "(SELECT * RENAME (value AS papd) FROM daily_measure)"
_PAPD_MID = "(SELECT * RENAME (value AS papd) FROM daily_measure WHERE DOW IN (3, 4, 5))"
_PAPH_MID = f"(SELECT * RENAME (value AS paph) FROM hourly_measure WHERE {dow('Date_Hour')} IN (3, 4, 5))"


@query("p03_ped_activations_week", WK.format(v="papd"), rollup(sub(weekly_sum(_PAPD_MID, "papd")), "Date", "papd"))
def _(v):
    return _activations(v)["cor_wk_papd"]


@query("p03_ped_activations_week_hours", HR.format(v="paph"), rollup(sub(weekly_by_hour(_PAPH_MID, "paph")), "Hour", "paph", keep=True))
def _(v):
    return _activations(v)["cor_wk_paph"]


_PED_LOG = _PED.format(log="event_log")
_PED_DAILY = f"(SELECT SignalID, 0 AS CallPhase, Date, {week('Date')} AS Week, Avg_Max_Ped_Delay AS pd, Events FROM ({_PED_LOG}))"


@query("p04_ped_delay_week", WK.format(v="pd"), rollup(sub(weekly_avg(_PED_DAILY, "pd", "Events")), "Date", "pd", "Events"))
def _(v):
    daily = M.ped_delay(v.event_log(), max_free=30000)
    return P.ped_delay(stage(daily), v.corridors())["cor_wk_pd"]


_CU = f"""(SELECT AssetNum AS SignalID, 0 AS CallPhase, Date, {week('Date')} AS Week, AvgQuality / 100 AS uptime, 1 AS ones FROM comm_quality q
  JOIN corridors c ON q.AssetNum = c.SignalID WHERE CSDATE = Date AND Date >= c."Asof")"""


@query("p05_comm_uptime_month", MO.format(v="uptime"), rollup(f"(SELECT * EXCLUDE (ones) FROM ({monthly_avg(_CU, 'uptime', 'ones')}))", "Month", "uptime"))
def _(v):
    return P.comm_uptime(v.comm_quality(), v.corridors())["cor_mo_cu"]


@query("p05_comm_uptime_week_signals", "Zone_Group, Corridor, Date, ~uptime, ~delta", signal_rows(
    weekly_avg(_CU, "uptime", "ones"), rollup(f"(SELECT * EXCLUDE (ones) FROM ({weekly_avg(_CU, 'uptime', 'ones')}))", "Date", "uptime"), "Date", "uptime"))
def _(v):
    return P.comm_uptime(v.comm_quality(), v.corridors())["sig_wk_cu"]


def _volumes(v):
    vpd = v.daily_measure().withColumnRenamed("value", "vpd")
    h = v.hourly_measure().withColumnRenamed("value", "vph").withColumn("Hour", F.col("Date_Hour"))
    return P.volumes(vpd, h, v.corridors())


_VPD_MID = "(SELECT * RENAME (value AS vpd) FROM daily_measure WHERE DOW IN (3, 4, 5))"
_HV = "(SELECT * RENAME (value AS vph) FROM " + HOURS + ")"


@query("p06_volume_month", MO.format(v="vpd"), rollup(sub(monthly_avg(_VPD_MID, "vpd", None)), "Month", "vpd"))
def _(v):
    return _volumes(v)["cor_mo_vpd"]


@query("p06_volume_month_hours", HR.format(v="vph"), rollup(sub(monthly_volume(_HV, "vph")), "Hour", "vph", keep=True))
def _(v):
    return _volumes(v)["cor_mo_vph"]


@query(
    "p06_morning_peak_month", "Zone_Group, Corridor, Month, ~vph, ~delta",
    f"""SELECT *, {delta('vph', 'Zone_Group, Corridor', 'Month')} AS delta FROM (SELECT Zone_Group, Corridor, cast(Hour as date) AS Month, avg(vph) AS vph
    FROM ({rollup(sub(monthly_volume(_HV, 'vph')), 'Hour', 'vph', keep=True)}) WHERE extract(hour from Hour) IN (6, 7, 8, 9) GROUP BY ALL)""",
)
def _(v):
    return _volumes(v)["cor_mo_vphpa"]


_TP = "(SELECT * RENAME (value AS vph) FROM daily_measure)"


@query("p07_throughput_week", WK.format(v="vph"), rollup(sub(weekly_sum(_TP, "vph")), "Date", "vph"))
def _(v):
    return P.throughput(v.daily_measure().withColumnRenamed("value", "vph"), v.corridors())["cor_wk_tp"]


def _ratio_checks(pid: str, package, var: str, wt: str, table: str, hours: str, peak_only: bool = True) -> None:
    """Week and month of the peak hours, and the month's hourly pattern."""
    where = f"WHERE {peak('Date_Hour')}" if peak_only else ""
    src = named("hourly_measure", var, wt)

    @query(f"{pid}_week", WK.format(v=var), rollup(sub(weekly_avg(src, var, wt, where)), "Date", var, wt))
    def _(v):
        return package(v)[f"cor_wk_{table}"]

    @query(f"{pid}_month_subcorridors", MO.format(v=var), rollup(sub(monthly_avg(src, var, wt, where)), "Month", var, wt, level="subcorridors"))
    def _(v):
        return package(v)[f"sub_mo_{table}"]

    @query(f"{pid}_hours", HR.format(v=var), rollup(sub(monthly_by_hour(sub(avg_by_hour(src, var, wt)), var, wt)), "Hour", var, wt, keep=True))
    def _(v):
        return package(v)[f"cor_mo_{hours}"]


_ratio_checks("p08_arrivals_on_green", lambda v: P.arrivals_on_green(hours_as(v, "aog", "vol"), v.corridors()), "aog", "vol", "aogd", "aogh")
_ratio_checks("p09_progression", lambda v: P.progression(hours_as(v, "pr", "vol"), v.corridors()), "pr", "vol", "prd", "prh")
_ratio_checks("p11_queue_spillback", lambda v: P.queue_spillback(hours_as(v, "qs_freq", "cycles"), v.corridors()), "qs_freq", "cycles", "qsd", "qsh")

_SF = "(SELECT * REPLACE (0 AS CallPhase) FROM " + named("hourly_measure", "sf_freq", "cycles") + ")"


def _failures(v):
    return P.split_failures(hours_as(v, "sf_freq", "cycles").withColumn("CallPhase", F.lit(0)), v.corridors())


def _sf_where(negate: str = "") -> str:
    return f"(SELECT * FROM {_SF} WHERE {negate} {peak('Date_Hour')})"


@query("p10_split_failures_peak_week", WK.format(v="sf_freq"), rollup(sub(weekly_avg(_sf_where(), "sf_freq", "cycles")), "Date", "sf_freq", "cycles"))
def _(v):
    return _failures(v)["cor_wk_sfd"]


@query("p10_split_failures_off_peak_month", MO.format(v="sf_freq"), rollup(sub(monthly_avg(_sf_where("NOT"), "sf_freq", "cycles")), "Month", "sf_freq", "cycles"))
def _(v):
    return _failures(v)["cor_mo_sfo"]


_LEVELS = f"(SELECT SignalID, Date, 0 AS CallPhase, {week('Date')} AS Week, cast(max(weight) as int) AS Level, 1 AS ones FROM daily_measure GROUP BY ALL)"


@query("p12_detection_levels_month", MO.format(v="Level"), rollup(f"(SELECT * EXCLUDE (ones) FROM ({monthly_avg(_LEVELS, 'Level', 'ones')}))", "Month", "Level"))
def _(v):
    levels = v.daily_measure().groupBy("SignalID", "Date").agg(F.max("weight").cast("int").alias("Level"))
    return P.detection_levels(levels, v.corridors())["cor_mo_dl"]


_TERM = f"""(SELECT SignalID, CallPhase, Date, {week('Date')} AS Week, value / 100 AS GapOut, value / 50 AS MaxOut, value / 25 AS ForceOff, weight AS Cycles FROM daily_measure)"""


def _terminations(v):
    d = v.daily_measure()
    shares = {"GapOut": 100, "MaxOut": 50, "ForceOff": 25}
    d = d.select("SignalID", "CallPhase", "Date", F.col("weight").alias("Cycles"), *[(F.col("value") / n).alias(c) for c, n in shares.items()])
    return P.terminations(d, v.corridors())


@query("p13_terminations_week", WK.format(v="MaxOut"), rollup(sub(weekly_avg(_TERM, "MaxOut", "Cycles")), "Date", "MaxOut", "Cycles"))
def _(v):
    return _terminations(v)["cor_wk_mo"]


@query("p13_terminations_day", "Zone_Group, Corridor, Date, ~GapOut, ~delta", rollup(_TERM, "Date", "GapOut", "Cycles"))
def _(v):
    return _terminations(v)["cor_dy_go"]


_TINT = f"(SELECT SignalID, 0 AS CallPhase, Date, {week('Date')} AS Week, tint, 1 AS ones FROM ({TINT_SQL.replace('event_log_day', 'event_log')}))"


@query("p14_time_in_transition_week", WK.format(v="tint"), rollup(f"(SELECT * EXCLUDE (ones) FROM ({weekly_avg(_TINT, 'tint', 'ones')}))", "Date", "tint"))
def _(v):
    return P.time_in_transition(stage(M.time_in_transition(v.event_log())), v.corridors())["cor_wk_tint"]


_DELAY = named(HOURS, "delay", "vol")
_DELAY_DAY = f"(SELECT *, 0 AS CallPhase, {week('Date')} AS Week FROM ({period_avg(_DELAY, 'Date', 'delay', 'vol')}))"


@query("p15_approach_delay_month", MO.format(v="delay"), rollup(sub(monthly_avg(_DELAY_DAY, "delay", "vol")), "Month", "delay", "vol"))
def _(v):
    return P.approach_delay(hours_as(v, "delay", "vol").withColumn("Hour", F.col("Date_Hour")), v.corridors())["cor_mo_ad"]


@query("p15_approach_delay_quarter", "Corridor, Zone_Group, Quarter, ~delay, ~delta",
       quarterly(rollup(sub(monthly_avg(_DELAY_DAY, "delay", "vol")), "Month", "delay", "vol"), "delay", "avg(delay)"))
def _(v):
    return P.approach_delay(hours_as(v, "delay", "vol").withColumn("Hour", F.col("Date_Hour")), v.corridors())["cor_qu_ad"]


# Hour and quarter-hour packages ---------------------------------------------------------------


def _package(v, period: str, make=P.hourly_package):
    minutes = 15 if period == "Timeperiod" else 60
    counted = C.counts(v.event_log(), v.ped_config(), minutes=minutes, code=90)
    pa = counted.select("SignalID", F.col("Timeperiod").alias(period), "Detector", F.col("vol").alias("paph"))
    bad = v.alerts().where("Alert = 'Bad Ped Detection'").select("SignalID", "Detector", "Date").distinct()
    vol = A.volume_per_period(C.counts(v.event_log(), v.det_config(), minutes=minutes), minutes=minutes).drop("Week", "DOW")
    base = C.counts(v.event_log(), v.det_config(), minutes=minutes).where("CallPhase is not null").groupBy(
        "SignalID", "CallPhase", F.col("Timeperiod").alias("Date_Hour")
    ).agg(F.count("*").alias("n"), (F.sum("vol") / 10).alias("x"))
    aog = base.select("SignalID", "CallPhase", "Date_Hour", F.col("x").alias("aog"), (F.col("x") * 2).alias("pr"), F.col("n").alias("vol"))
    sf = base.select("SignalID", F.lit(0).alias("CallPhase"), "Date_Hour", F.col("x").alias("sf_freq"), F.col("n").alias("cycles"))
    qs = base.select("SignalID", "CallPhase", "Date_Hour", F.col("x").alias("qs_freq"), F.col("n").alias("cycles"))
    delay = base.select("SignalID", F.col("Date_Hour").alias(period), F.col("x").alias("delay"), F.col("n").alias("vol"))
    return make(pa, bad, vol, aog, sf, qs, delay, v.corridors(), start="2024-01-01", end="2024-02-01", period=period)


def _base(counts: str) -> str:
    return f"(SELECT SignalID, CallPhase, Timeperiod, count(*) AS n, sum(vol) / 10 AS x FROM {counts} WHERE CallPhase IS NOT NULL GROUP BY ALL)"


_PA = f"""(SELECT SignalID, Timeperiod AS Hour, vol AS paph FROM counts_ped_1h c ANTI JOIN (SELECT DISTINCT SignalID, Detector, Date FROM alerts WHERE Alert = 'Bad Ped Detection') b
  ON c.SignalID = b.SignalID AND c.Detector = b.Detector AND cast(c.Timeperiod as date) = b.Date)"""


@query("p16_hourly_ped_activations", HR.format(v="paph"), rollup(sub(period_sum(_PA, "Hour", "paph")), "Hour", "paph"))
def _(v):
    return _package(v, "Hour")["cor_hourly_pa"]


def _source(per: str, col: str, phase: str) -> str:
    counts = "counts_1h" if per == "Hour" else "counts_15"
    return f"(SELECT SignalID, {phase} AS CallPhase, Timeperiod AS {per}, n AS vol, x AS {col} FROM {_base(counts)})"


def _span(per: str, col: str) -> str:
    """A null row for each signal's period of the report without data."""
    step, src = ("1 hour" if per == "Hour" else "15 minute"), _source(per, col, "CallPhase")
    return f"""(SELECT g.SignalID, g.{per}, s.{col}, s.vol FROM (SELECT SignalID, unnest(generate_series(timestamp '2024-01-01', timestamp '2024-02-01' - interval {step}, interval {step})) AS {per}
      FROM (SELECT DISTINCT SignalID FROM {src})) g LEFT JOIN {src} s USING (SignalID, {per}))"""


def _zeros(per: str, col: str, phase: str, whole: bool = False) -> str:
    """0 in the missing periods of an entity's days with data, or of the whole report."""
    step, src = ("1 hour" if per == "Hour" else "15 minute"), _source(per, col, phase)
    lo, hi = ("timestamp '2024-01-01'", "timestamp '2024-02-01'") if whole else ("day", "day + interval 1 day")
    day = "" if whole else f", date_trunc('day', {per}) AS day"
    return f"""(SELECT g.SignalID, g.{per}, coalesce(s.{col}, 0) AS {col}, 1 AS ones FROM (SELECT SignalID, CallPhase, unnest(generate_series({lo}, {hi} - interval {step}, interval {step})) AS {per}
      FROM (SELECT DISTINCT SignalID, CallPhase{day} FROM {src})) g LEFT JOIN {src} s USING (SignalID, CallPhase, {per}))"""


def _period_queries() -> None:
    """Arrivals, progression, failures and spillback of both packages, all three levels among them."""
    for number, per, word in (("p16", "Hour", "hourly"), ("p17", "Timeperiod", "15min")):
        sources = {
            "aog": (_span(per, "aog"), "aog", "vol", "sig"),
            "pr": (_span(per, "pr").replace("x AS pr", "x * 2 AS pr"), "pr", "vol", "sub"),
            "sf": (_zeros(per, "sf_freq", "0", whole=per == "Timeperiod"), "sf_freq", "ones", "cor"),
            "qs": (_zeros(per, "qs_freq", "CallPhase"), "qs_freq", "ones", "sub" if per == "Hour" else "cor"),
        }
        for table, (src, col, wt, level) in sources.items():
            signals = f"(SELECT * EXCLUDE ({wt}) FROM ({period_avg(src, per, col, wt)}))"
            sql = rollup(signals, per, col, level="subcorridors" if level == "sub" else "corridors")
            if level == "sig":
                spec, sql = f"Zone_Group, Corridor, {per}, ~{col}, ~delta", signal_rows(signals[1:-1], sql, per, col)
            else:
                spec = f"Zone_Group, Corridor, {per}, ~{col}, ~delta"
            query(f"{number}_{word}_{table}_{level}", spec, sql)(lambda v, per=per, name=f"{level}_{word}_{table}": _package(v, per)[name])


_period_queries()


# All levels at once ----------------------------------------------------------------------------

LEVEL_COLS = "level, per, table, Zone_Group, Corridor, at, ~value, ~delta"


def _level_sql(signals: str, per: str, col: str, wt: str | None, table: str, *, label: str | None = None, delta_of: str | None = None, named: bool = False) -> str:
    """A table's rows of corridors, subcorridors and signals, in long form."""
    parts = []
    for level in ("cor", "sub", "sig"):
        hierarchy = "subcorridors" if level == "sub" else "corridors"
        sql = rollup(signals, per, col, wt, level=hierarchy) if wt else rollup(signals, per, col, level=hierarchy)
        if level == "sig":
            sql = signal_rows(delta_of or signals[1:-1], sql, per, col)
            sql = f"SELECT * FROM ({sql}) WHERE Zone_Group IS NOT NULL" if named else sql
        parts.append(f"""SELECT '{level}' AS level, '{label or per}' AS per, '{table}' AS "table", Zone_Group, Corridor, cast({per} as timestamp) AS at, {col} AS value, delta FROM ({sql})""")
    return " UNION ALL ".join(parts)


def _hour_levels(per: str, word: str) -> str:
    counts, ped, minutes = ("counts_1h", _PA, 60) if per == "Hour" else ("counts_15", _PA_15, 15)
    volumes = f"(SELECT SignalID, Timeperiod AS {per}, vol AS vph FROM {counts} WHERE CallPhase IN (2, 6))"
    whole = per == "Timeperiod"
    x2 = _span(per, "pr").replace("x AS pr", "x * 2 AS pr")
    tables = {
        "pa": (period_sum(ped, per, "paph"), "paph"), "vol": (period_sum(volumes, per, "vph"), "vph"),
        "aog": (period_avg(_span(per, "aog"), per, "aog", "vol"), "aog"), "pr": (period_avg(x2, per, "pr", "vol"), "pr"),
        "sf": (period_avg(_zeros(per, "sf_freq", "0", whole=whole), per, "sf_freq", "ones"), "sf_freq"),
        "qs": (period_avg(_zeros(per, "qs_freq", "CallPhase"), per, "qs_freq", "ones"), "qs_freq"),
        "ad": (period_avg(_source(per, "delay", "CallPhase"), per, "delay", "vol"), "delay"),
    }
    return " UNION ALL ".join(_level_sql(f"(SELECT SignalID, {per}, {col}, delta FROM ({sql}))", per, col, None, f"{word}_{table}") for table, (sql, col) in tables.items())


_PA_15 = _PA.replace("counts_ped_1h", "counts_ped_15").replace("Timeperiod AS Hour", "Timeperiod")


@query("p16_all_levels", LEVEL_COLS, _hour_levels("Hour", "hourly"))
def _(v):
    return _package(v, "Hour", P.hourly_levels)


@query("p17_all_levels", LEVEL_COLS, _hour_levels("Timeperiod", "15min"))
def _(v):
    return _package(v, "Timeperiod", P.hourly_levels)


_A28 = {"dy": (f"SELECT * FROM {_DAILY_P}", "Date"), "wk": (_AGG_WK, "Date"), "mo": (_AGG_MO, "Month")}


def _daily_value(v):
    daily = A.daily_avg(v.daily_measure(), "value", "weight").withColumn("CallPhase", F.lit(0)).withColumn("Week", X.week("Date"))
    return stage(daily)


@query("a28_all_levels", LEVEL_COLS, " UNION ALL ".join(
    _level_sql(f"({sql})", at, "value", "weight", "m", label=per, named=True) for per, (sql, at) in _A28.items()))
def _(v):
    return P.measure_levels(METRIC, _daily_value(v), v.corridors())[0]


@query("a28_all_quarters", "level, table, Zone_Group, Corridor, Quarter, ~value, ~delta",
       f"""SELECT *, {delta('value', 'level, "table", Corridor, Zone_Group', 'Quarter')} AS delta FROM (SELECT level, "table", Zone_Group, Corridor,
       extract(year from "at") || '.' || extract(quarter from "at") AS Quarter, avg(value) AS value FROM ({_level_sql(f"({_AGG_MO})", "Month", "value", "weight", "m", label="mo", named=True)}) GROUP BY ALL)""")
def _(v):
    return P.measure_levels(METRIC, _daily_value(v), v.corridors())[1]


@query("p18_quarters_of_bundle", "Corridor, Zone_Group, Quarter, ~vph, ~delta", quarterly(
    rollup(sub(monthly_avg(_TP, "vph", None)), "Month", "vph"), "vph", "arg_max(vph, Month)"))
def _(v):
    bundle = P.throughput(v.daily_measure().withColumnRenamed("value", "vph"), v.corridors())
    return P.with_quarters(bundle, "tp", METRICS["tp"].variable, operation="latest")["cor_qu_tp"]


@query("p18_travel_time_bundle", "Zone_Group, Corridor, Hour, ~spd, ~delta", index_sql(with_shares(False), "Hour", "spd", keep=True))
def _(v):
    return P.travel_times(v.segment_readings(), corridor_volumes(v), v.corridors(), GROUP)["cor_mo_spdh"]



def _published_twice(v, first, again, start: str, **window):
    """A frame of all levels published, then its window again."""
    name = f"levels_{uuid.uuid4().hex}"
    v.spark.sql(f"CREATE DATABASE {name} LOCATION '{new_path(v.spark, 'levels')}'")
    target = Target("at", variable="value")
    publish(v.spark, first, f"{name}.levels", target)
    publish(v.spark, again, f"{name}.levels", target, start=start, **window)
    return v.spark.table(f"{name}.levels")


def _from(start: str, sql: str, where: str = "true") -> str:
    return f"""SELECT * REPLACE (CASE WHEN "at" >= timestamp '{start}' THEN value * 2 ELSE value END AS value) FROM ({sql}) WHERE {where}"""


@query("s25_publish_hourly_levels", LEVEL_COLS, _from("2024-01-20", _hour_levels("Hour", "hourly")))
def _(v):
    # All 21 hourly tables as one published table; the window begins inside its month.
    levels = stage(_package(v, "Hour", P.hourly_levels))
    return _published_twice(v, levels, levels.withColumn("value", F.col("value") * 2), "2024-01-20")


_ALL_A28 = " UNION ALL ".join(_level_sql(f"({sql})", at, "value", "weight", "m", label=per, named=True) for per, (sql, at) in _A28.items())


@query("s25_publish_measure_levels", LEVEL_COLS, _from("1999-01-01", _ALL_A28, "\"at\" >= timestamp '1996-01-01' AND \"at\" < timestamp '2000-07-01'"))
def _(v):
    levels = stage(P.measure_levels(METRIC, _daily_value(v), v.corridors())[0])
    again = levels.where("at >= timestamp_ntz'1999-01-01'").withColumn("value", F.col("value") * 2)
    return _published_twice(v, levels, again, "1999-01-01", report_start="1996-01-01", report_end="2000-06-01")


def _sub_sql(sql: str) -> str:
    """The SQL of a corridor table moved down one level: readings by subcorridor under the hierarchy's view, volumes of the same level."""
    moved = "(SELECT Zone AS Zone_Group, Corridor AS Zone, Subcorridor AS Corridor, * EXCLUDE (Zone_Group, Zone, Corridor, Subcorridor) FROM {})"
    return sql.replace("segment_readings", "sub_readings").replace("corridors", "subcorridors").replace("sub_readings", moved.format("segment_readings"))


def _sub_volumes(v):
    h = v.hourly_measure().join(K.subcorridor_view(v.corridors()).select("SignalID", *GROUP), "SignalID")
    return h.groupBy(*GROUP, F.col("Date_Hour").alias("Hour")).agg(F.coalesce(F.sum("value"), F.lit(0)).alias("vph"))


@query("p18_travel_subcorridor_hour", "Zone_Group, Corridor, Hour, ~spd, ~delta", _sub_sql(index_sql(with_shares(False), "Hour", "spd", keep=True)))
def _(v):
    return P.travel_package(v.segment_readings(), corridor_volumes(v), _sub_volumes(v), v.corridors())["sub_mo_spdh"]


@query("p18_travel_subcorridor_week", "Zone_Group, Corridor, Date, ~pti, ~delta", _sub_sql(index_sql(f"SELECT *, cast(Hour as date) AS Date FROM ({with_shares(True)})", "Date", "pti")))
def _(v):
    return P.travel_package(v.segment_readings(), corridor_volumes(v), _sub_volumes(v), v.corridors())["sub_wk_pti"]


_CAM = "(SELECT 'CAM' || (cast(SignalID as int) % 4) AS CameraID, Corridor, min(Name) AS Location FROM corridors GROUP BY ALL)"
_CAM_DAYS = "(SELECT 'CAM' || (cast(SignalID as int) % 4) AS CameraID, Corridor, Date, avg(value) AS up FROM daily_measure JOIN corridors USING (SignalID) GROUP BY ALL)"
_CAM_COR = f"(SELECT Corridor, Date, avg(up) AS up FROM {_CAM_DAYS} GROUP BY ALL)"


@query("a27_camera_rows", "Zone_Group, Corridor, Name, Description, Date, ~up",
       f"""SELECT d.Corridor AS Zone_Group, d.CameraID AS Corridor, c.Location AS Name, d.CameraID AS Description, Date, up FROM {_CAM_DAYS} d LEFT JOIN {_CAM} c
       ON d.Corridor = c.Corridor AND d.CameraID = c.CameraID UNION ALL SELECT Corridor, Corridor, NULL, Corridor, Date, up FROM {_CAM_COR}""")
def _(v):
    camera = F.concat(F.lit("CAM"), F.col("SignalID").cast("int") % 4).alias("CameraID")
    cameras = v.corridors().groupBy(camera, "Corridor").agg(F.min("Name").alias("Location"))
    days = v.daily_measure().join(v.corridors(), "SignalID").groupBy(camera, "Corridor", "Date").agg(F.avg("value").alias("up"))
    return A.signal_rows(days, days.groupBy("Corridor", "Date").agg(F.avg("up").alias("up")), cameras, "CameraID")
