"""The day and month jobs (C02, C07, M29), all rows of all their tables."""

from functools import reduce

from pyspark.sql import DataFrame

from checks.q_counts import LOW_HOURLY, LOW_QUARTER
from checks.q_measures import _DAY100, _DET_UP, _PED, _SF_ARGS, TINT_SQL, _scaled_cycles, _vpd, aog_sql, delay_sql, hour, qs_sql, quarter_hour, sf_sql
from checks.q_measures import SIGNAL_UP, SYSTEM_UP
from checks.q_rollups import DDU
from checks.q_serving import _DETAILS
from checks.registry import query
from phasewright.operators import counts as C
from phasewright.plans import jobs as J
from phasewright.plans.imputation import adjust_changed, read_adjusted
from phasewright.session import new_path, stage
from phasewright.sources import tables as S

COLS = "name, SignalID, Date, key, data"
LINES = ["vol", "delta_vol", "mean_abs_delta", "flatlined", "flat_strk", "flat_flag", "maxvol_flag", "mad_flag", "Good_Day"]
TINT = [f"TimeInTransition_{x}" for x in ("min", "median", "max")] + ["Transitions", "tint"] + [f"CyclesInTransition_{x}" for x in ("min", "median", "max", "sum")]
PLACE = ["Detector", "CallPhase"]

# Per table: key, values and period, as both sides fold them.
SHAPES = {
    "comm_uptime": (["CallPhase"], ["uptime"], None),
    "counts_1hr": (PLACE, ["vol"], "Timeperiod"), "counts_15min": (PLACE, ["vol"], "Timeperiod"),
    "counts_ped_1hr": (PLACE, ["vol"], "Timeperiod"), "counts_ped_15min": (PLACE, ["vol"], "Timeperiod"),
    "filtered_counts_1hr": (PLACE, LINES, "Timeperiod"), "filtered_counts_15min": (PLACE, LINES, "Timeperiod"),
    "bad_detectors": (["Detector"], ["Good_Day"], None), "detector_uptime_pd": (["CallPhase", "setback"], ["uptime", "all"], "Date_Hour"),
    "ped_actuations_pd": (["CallPhase"], ["papd"], None), "ped_actuations_ph": ([], ["paph"], "Hour"),
    "adjusted_counts_1hr": (PLACE, ["vol"], "Timeperiod"), "adjusted_counts_15min": (PLACE, ["vol"], "Timeperiod"),
    "signal_details": (PLACE, ["vol_rc", "vol_ac", "bad_day"], "Timeperiod"),
    "month_bad_detectors": (["Detector"], ["Good_Day"], None), "month_detector_uptime_pd": (["CallPhase", "setback"], ["uptime", "all"], "Date_Hour"),
    "vehicles_pd": (["CallPhase"], ["vpd"], None), "vehicles_ph": ([], ["vph"], "Hour"), "throughput": (["CallPhase"], ["vph"], None),
    "vehicles_15min": ([], ["vph"], "Timeperiod"), "month_ped_actuations_pd": (["CallPhase"], ["papd"], None),
    "month_ped_actuations_ph": ([], ["paph"], "Hour"), "month_ped_actuations_15min": ([], ["pa15"], "Timeperiod"),
    "arrivals_on_green": (["CallPhase"], ["aog", "pr", "vol"], "Date_Hour"), "arrivals_on_green_15min": (["CallPhase"], ["aog", "pr", "vol"], "Date_Hour"),
    "split_failures": (["CallPhase"], ["sf", "cycles", "sf_freq"], "Date_Hour"), "sf_15min": (["CallPhase"], ["sf", "cycles", "sf_freq"], "Date_Hour"),
    "queue_spillback": (["CallPhase"], ["qs", "cycles", "qs_freq"], "Date_Hour"), "qs_15min": (["CallPhase"], ["qs", "cycles", "qs_freq"], "Date_Hour"),
    "ped_delay": (["Pattern"], ["Avg_Max_Ped_Delay", "Events"], None),
    "approach_delay_1hr": ([], ["delay", "vol"], "Hour"), "approach_delay_15min": ([], ["delay", "vol"], "Hour"),
    "phase_termination": (["CallPhase"], ["Cycles", "GapOut", "MaxOut", "ForceOff"], None), "time_in_transition": ([], TINT, None),
}


def folded(bodies: dict[str, str]) -> str:
    """The SQL of tables in the shape of ``jobs.rows_of_day``."""
    out = []
    for name, body in bodies.items():
        key, values, period = SHAPES[name]
        number = [f"""coalesce(cast(cast(floor(cast("{v}" AS double) * 1e6 + 0.50037) AS bigint) AS varchar), '-')""" for v in values]
        item = f"concat_ws(',', {', '.join([f'cast({period} AS varchar)'] * bool(period) + number)})"
        place = "concat_ws('|', " + ", ".join(f"coalesce(cast({k} AS varchar), '-')" for k in key) + ")" if key else "''"
        out.append(f"SELECT '{name}' AS name, SignalID, cast(Date AS date) AS Date, {place} AS key, string_agg({item}, ';' ORDER BY {item}) AS data FROM ({body}) GROUP BY ALL")
    return " UNION ALL ".join(out)


def tables(spark, base: str, names) -> DataFrame:
    def one(name: str) -> DataFrame:
        df = J.read_job_table(spark, base, name)
        if name == "signal_details":
            df = S.read_signal_details(df).withColumn("Date", S.F.to_date("Timeperiod"))
        return J.rows_of_day(df, name, *SHAPES[name])

    return reduce(DataFrame.unionByName, [one(name) for name in names])


def _dated(src: str) -> str:
    return f"SELECT *, cast(Timeperiod AS date) AS Date FROM {src}"


def _sum(src: str, period: str, to: str, where: str = "") -> str:
    return f"SELECT SignalID, cast({period} AS date) AS Date, {period}, sum(vol) AS {to} FROM (SELECT *, Timeperiod AS Hour FROM {src} {where}) GROUP BY ALL"


COUNTS = {
    "comm_uptime": f"SELECT s.SignalID, 0 AS CallPhase, s.Date, s.uptime + (1 - a.uptime) AS uptime FROM ({SIGNAL_UP}) s LEFT JOIN ({SYSTEM_UP}) a ON s.Date = a.Date",
    "counts_1hr": _dated("counts_1h"), "counts_15min": _dated("counts_15"), "counts_ped_1hr": _dated("counts_ped_1h"), "counts_ped_15min": _dated("counts_ped_15"),
    "filtered_counts_1hr": "SELECT * FROM filtered_1h", "filtered_counts_15min": "SELECT * FROM filtered_15",
    "bad_detectors": f"SELECT * FROM ({_DET_UP}) WHERE Good_Day = 0", "detector_uptime_pd": DDU,
    "ped_actuations_pd": _vpd("counts_ped_1h", "papd"), "ped_actuations_ph": _sum("counts_ped_1h", "Hour", "paph"),
}
MONTH = {
    "adjusted_counts_1hr": "SELECT * FROM adjusted_sel", "adjusted_counts_15min": "SELECT * FROM adjusted_sel_15",
    "signal_details": f"SELECT *, cast(Timeperiod AS date) AS Date FROM ({_DETAILS.replace('adjusted_1h', 'adjusted_sel')})",
    "month_bad_detectors": COUNTS["bad_detectors"], "month_detector_uptime_pd": DDU,
    "vehicles_pd": _vpd("adjusted_sel", "vpd", "WHERE CallPhase IN (2, 6)"), "vehicles_ph": _sum("adjusted_sel", "Hour", "vph", "WHERE CallPhase IN (2, 6)"),
    "throughput": """SELECT SignalID, Date, 0 AS CallPhase, quantile_cont(s, 0.95) * 4 AS vph FROM (SELECT SignalID, cast(Timeperiod AS date) AS Date, Timeperiod, sum(vol) AS s
      FROM adjusted_sel_15 GROUP BY ALL) GROUP BY ALL""",
    "vehicles_15min": _sum("adjusted_sel_15", "Timeperiod", "vph", "WHERE CallPhase IN (2, 6)").replace("SELECT *, Timeperiod AS Hour", "SELECT *"),
    "month_ped_actuations_pd": COUNTS["ped_actuations_pd"], "month_ped_actuations_ph": COUNTS["ped_actuations_ph"],
    "month_ped_actuations_15min": _sum("counts_ped_15", "Timeperiod", "pa15").replace("SELECT *, Timeperiod AS Hour", "SELECT *"),
}


def _aog(minutes: int) -> str:
    return f"SELECT SignalID, Phase AS CallPhase, Date, Hour AS Date_Hour, AOG AS aog, pr, All_Arrivals AS vol FROM ({aog_sql(minutes)})"


def _delay(fl, minutes: int) -> str:
    return f"SELECT *, cast(Hour AS date) AS Date FROM ({delay_sql(fl, minutes)})"


MEASURES = {
    "arrivals_on_green": _aog(60), "arrivals_on_green_15min": _aog(15), "split_failures": sf_sql(hour), "sf_15min": sf_sql(quarter_hour),
    "queue_spillback": qs_sql(hour), "qs_15min": qs_sql(quarter_hour), "ped_delay": _PED.format(log=_DAY100),
    "approach_delay_1hr": _delay(hour, 60), "approach_delay_15min": _delay(quarter_hour, 15),
    "phase_termination": """SELECT SignalID, Phase AS CallPhase, Date, count(*) AS Cycles, count(*) FILTER (WHERE TermType = 4) / count(*) AS GapOut,
      count(*) FILTER (WHERE TermType = 5) / count(*) AS MaxOut, count(*) FILTER (WHERE TermType = 6) / count(*) AS ForceOff FROM cycles WHERE EventCode = 1 AND TermType <> 0 GROUP BY ALL""",
    "time_in_transition": TINT_SQL,
}


def _counted(v) -> str:
    base = new_path(v.spark, "count-job")
    log = v.event_log()
    J.run_job(v.spark, J.count_job(v.det_config(), v.ped_config(), LOW_HOURLY, LOW_QUARTER), log, J.log_versions(log), base)
    return base


@query("c02_count_job", COLS, folded(COUNTS))
def _(v):
    return tables(v.spark, _counted(v), COUNTS)


@query("c07_month_job", COLS, folded(MONTH))
def _(v):
    base = _counted(v)
    versions = J.table_versions(v.spark, base, "counts_1hr")
    J.run_job(v.spark, J.month_job(v.det_config()), v.event_log(), versions, base, lambda name: J.read_job_table(v.spark, base, name))
    return tables(v.spark, base, MONTH)


@query("m29_measure_job", COLS, folded(MEASURES))
def _(v):
    base = new_path(v.spark, "event-job")
    log = _scaled_cycles(v.stored_day())
    job = J.event_job(v.det_config(), split_failures=_SF_ARGS, queue_spillback={"threshold": 1800}, ped_delay={"max_free": 30000})
    J.run_job(v.spark, job, log, J.log_versions(log), base)
    return tables(v.spark, base, MEASURES)


@query("c06_adjust_changed", "SignalID, CallPhase:int, Detector:int, Timeperiod, vol:int, Date", "SELECT * FROM adjusted_1h")
def _(v):
    # The month is imputed without its last days, then with them: the rows are those of one run over all.
    base = new_path(v.spark, "adjusted")
    filtered = stage(C.filter_counts(C.counts(v.event_log(), v.det_config()), v.det_config(), LOW_HOURLY))
    adjust_changed(v.spark, filtered.where("Date < date'2024-01-25'"), base)
    adjust_changed(v.spark, filtered, base)
    return read_adjusted(v.spark, base)
