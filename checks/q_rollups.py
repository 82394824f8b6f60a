"""Rollups by period and level (A01-A37) and the calendar and completion expressions."""

from pyspark.sql import functions as F

from checks.q_counts import LOW_HOURLY
from checks.registry import query
from checks.views_sql import PEAK, corridor_cte, delta, dow, hour, peak, quarter_hour, rollup, week, wmean, zone_union
from phasewright.functions import calendar as X
from phasewright.operators import counts as C
from phasewright.operators import detectors as K
from phasewright.operators import rollups as A
from phasewright.operators import runs as R
from phasewright.plans import packages as P
from phasewright.schemas import Metric
from phasewright.session import stage

S = "SignalID"


def tuesday(week_col: str, first: str) -> str:
    return f"greatest(date '2016-12-25' + cast({week_col} * 7 + CASE WHEN {week_col} < 0 THEN -5 ELSE 2 END as int), {first})"


def month(d: str) -> str:
    return f"cast(date_trunc('month', {d}) as date)"


def onto_month(ts: str) -> str:
    return f"(date_trunc('month', {ts}) + ({ts} - date_trunc('day', {ts})))"


# Signal-level SQL -----------------------------------------------------------------------------


def period_avg(src: str, per: str, v: str = "value", w: str = "weight") -> str:
    return f"SELECT *, {delta(v, S, per)} AS delta FROM (SELECT SignalID, {per}, {wmean(v, w)} AS {v}, sum({w}) AS {w} FROM {src} GROUP BY ALL)"


def period_sum(src: str, per: str, v: str = "value") -> str:
    return f"SELECT *, {delta(v, S, per)} AS delta FROM (SELECT SignalID, {per}, coalesce(sum({v}), 0) AS {v} FROM {src} GROUP BY ALL)"


def weekly_sum(src: str, v: str = "value") -> str:
    first = f"(SELECT min(Date) FROM {src})"
    return f"""SELECT *, {tuesday('Week', first)} AS Date, {delta(v, S, 'Week')} AS delta FROM (SELECT SignalID, Week, sum(m) AS {v} FROM (
      SELECT SignalID, Week, CallPhase, avg({v}) AS m FROM {src} GROUP BY ALL) GROUP BY ALL)"""


def weekly_avg(src: str, v: str = "value", w: str = "weight", where: str = "") -> str:
    first = f"(SELECT min(Date) FROM {src})"
    chosen = f"(SELECT * FROM {src} {where})"
    return f"""SELECT *, {tuesday('Week', first)} AS Date, {delta(v, S, 'Week')} AS delta FROM (
      SELECT SignalID, Week, {wmean('m', 'n')} AS {v}, coalesce(sum(n), 0) AS {w} FROM (
        SELECT g.SignalID, g.CallPhase, g.Week, p.m, p.n FROM (SELECT SignalID, CallPhase, cast(unnest(range(lo, hi + 1)) as int) AS Week FROM
          (SELECT DISTINCT SignalID, CallPhase FROM {chosen}), (SELECT min(Week) AS lo, max(Week) AS hi FROM {chosen})) g
        LEFT JOIN (SELECT SignalID, CallPhase, Week, {wmean(v, w)} AS m, sum({w}) AS n FROM {chosen} GROUP BY ALL) p USING (SignalID, CallPhase, Week))
      GROUP BY ALL)"""


def monthly_avg(src: str, v: str = "value", w: str | None = "weight", where: str = "") -> str:
    chosen = f"(SELECT *, {month('Date')} AS Month FROM {src} {where})"
    inner = f"{wmean(v, w)} AS m, sum({w}) AS n" if w else f"avg({v}) AS m, 0 AS n"
    outer = f"{wmean('m', 'n')} AS {v}, coalesce(sum(n), 0) AS {w}" if w else f"coalesce(sum(m), 0) AS {v}"
    return f"""SELECT *, {delta(v, S, 'Month')} AS delta FROM (SELECT SignalID, Month, {outer} FROM (
      SELECT g.SignalID, g.CallPhase, g.Month, p.m, p.n FROM (SELECT SignalID, CallPhase, cast(unnest(generate_series(cast(lo as timestamp), cast(hi as timestamp), interval 1 month)) as date)
        AS Month FROM (SELECT DISTINCT SignalID, CallPhase FROM {chosen}), (SELECT min(Month) AS lo, max(Month) AS hi FROM {chosen})) g
      LEFT JOIN (SELECT SignalID, CallPhase, Month, {inner} FROM {chosen} GROUP BY ALL) p USING (SignalID, CallPhase, Month)) GROUP BY ALL)"""


def weekly_by_hour(src: str, v: str = "value", ts: str = "Date_Hour", phase: str = "CallPhase") -> str:
    first = f"(SELECT min(cast({ts} as date)) FROM {src})"
    return f"""SELECT *, {delta(v, 'SignalID, Week', 'Hour')} AS delta FROM (SELECT SignalID, Week, Hour, avg(m) AS {v} FROM (
      SELECT SignalID, Week, {tuesday('Week', first)} + ({ts} - date_trunc('day', {ts})) AS Hour, {phase} AS ph, avg({v}) AS m FROM {src} GROUP BY ALL) GROUP BY ALL)"""


def avg_by_hour(src: str, v: str = "value", w: str = "weight") -> str:
    return f"""SELECT *, {week('cast(Hour as date)')} AS Week, {dow('Hour')} AS DOW, {delta(v, 'SignalID, CallPhase', 'Hour')} AS delta FROM (
      SELECT SignalID, CallPhase, {hour('Date_Hour')} AS Hour, {wmean(v, w)} AS {v}, sum({w}) AS {w} FROM {src} GROUP BY ALL)"""


def monthly_by_hour(src: str, v: str = "value", w: str = "weight") -> str:
    return f"""SELECT *, {delta(v, S, 'Hour')} AS delta FROM (SELECT SignalID, {onto_month('Hour')} AS Hour, {wmean(v, w)} AS {v}, sum({w}) AS {w} FROM (
      SELECT SignalID, Hour, {wmean(v, w)} AS {v}, sum({w}) AS {w} FROM {src} GROUP BY ALL) GROUP BY ALL)"""


def monthly_volume(src: str, v: str = "value") -> str:
    return f"""SELECT SignalID, {onto_month('Hour')} AS Hour, avg({v}) AS {v} FROM (SELECT SignalID, Hour, sum({v}) AS {v} FROM {src}
      WHERE {dow('Hour')} IN (3, 4, 5) GROUP BY ALL) GROUP BY ALL"""


HOURS = "(SELECT *, Date_Hour AS Hour FROM hourly_measure)"


def _hours(v):
    return v.hourly_measure().withColumn("Hour", F.col("Date_Hour"))


VPH = f"(SELECT SignalID, {hour('Timeperiod')} AS Hour, sum(vol) AS vph FROM counts_1h WHERE CallPhase IN (2, 6) GROUP BY ALL)"


def vph(v):
    return A.volume_per_period(C.counts(v.event_log(), v.det_config()))


# Flagship -------------------------------------------------------------------------------------

CP = "Zone_Group, Zone, Corridor"


@query("a04_hourly_volume_by_corridor", "Zone_Group, Corridor, Hour, ~vph, ones:bigint, ~delta", rollup(VPH, "Hour", "vph", keep=True))
def _(v):
    return A.corridor_by_hour(vph(v), v.corridors(), "vph")


@query("a01_by_corridor_weighted", f"{CP}, Date, ~value, weight:bigint, ~delta", corridor_cte("daily_measure", "corridors", "Date", "value", "weight", keep=True))
def _(v):
    return A.by_corridor(v.daily_measure(), v.corridors(), "Date", "value", "weight")


@query(
    "a01_by_corridor_plain", f"{CP}, Date, ~value, ~delta",
    f"""SELECT *, {delta('value', CP, 'Date')} AS delta FROM (SELECT {CP}, Date, avg(value) AS value FROM daily_measure JOIN corridors USING (SignalID) GROUP BY ALL)""",
)
def _(v):
    return A.by_corridor(v.daily_measure(), v.corridors(), "Date", "value")


_COR = corridor_cte("daily_measure", "corridors", "Date", "value", "weight", keep=True)


@query(
    "a02_zone_group_rows", "Zone_Group, Corridor, Date, ~value, weight:bigint, ~delta",
    f"""SELECT *, Zone_Group AS Corridor, {delta('value', 'Zone_Group', 'Date')} AS delta FROM (SELECT Zone_Group, Date, {wmean('value', 'weight')} AS value,
    sum(weight) AS weight FROM ({_COR}) GROUP BY ALL)""",
)
def _(v):
    return A.zone_group_rows(A.by_corridor(v.daily_measure(), v.corridors(), "Date", "value", "weight"), "Date", "value", "weight")


@query(
    "a03_zone_group_sums", "Zone_Group, Corridor, Date, ~value, ~delta",
    f"""SELECT *, Zone_Group AS Corridor, {delta('value', 'Zone_Group', 'Date')} AS delta FROM (SELECT Zone_Group, Date, sum(value) AS value
    FROM ({_COR}) GROUP BY ALL)""",
)
def _(v):
    return A.zone_group_sums(A.by_corridor(v.daily_measure(), v.corridors(), "Date", "value", "weight"), "Date", "value")


COR_COLS = "Zone_Group, Corridor, {p}, ~value, weight:bigint, ~delta"


@query("a04_with_zone_groups", COR_COLS.format(p="Date"), zone_union(_COR, "Date", "value", "weight"))
def _(v):
    return A.with_zone_groups(A.by_corridor(v.daily_measure(), v.corridors(), "Date", "value", "weight"), "Date", "value", "weight")


@query(
    "a05_hourly", f"SignalID, Hour, ~vph, ~delta, {CP}, Subcorridor",
    f"""SELECT c.SignalID, Hour, vph, {delta('vph', 'c.SignalID', 'Hour')} AS delta, {CP}, Subcorridor FROM corridors c LEFT JOIN {VPH} v ON c.SignalID = v.SignalID""",
)
def _(v):
    return A.hourly(vph(v), "vph", v.corridors())


@query("a06_period_avg", "SignalID, Date, ~value, weight:bigint, ~delta", period_avg("daily_measure", "Date"))
def _(v):
    return A.period_avg(v.daily_measure(), "value", "Date", "weight")


@query("a07_period_sum", "SignalID, Date, ~value, ~delta", period_sum("daily_measure", "Date"))
def _(v):
    return A.period_sum(v.daily_measure(), "value", "Date")


@query("a08_daily_avg_peak", "SignalID, Date, ~value, weight:bigint, ~delta", period_avg(f"(SELECT * FROM hourly_measure WHERE {peak('Date_Hour')})", "Date"))
def _(v):
    return A.daily_avg(v.hourly_measure(), "value", "weight", peak_only=True)


@query(
    "a09_daily_aog", "SignalID, Date, ~aog, vol:bigint, ~delta",
    period_avg(f"(SELECT SignalID, Date, value AS aog, weight AS vol FROM hourly_measure WHERE {peak('Date_Hour')})", "Date", "aog", "vol"),
)
def _(v):
    return A.daily_aog(v.hourly_measure().withColumnsRenamed({"value": "aog", "weight": "vol"}))


@query(
    "a10_volume_per_hour", "SignalID, Hour, Week:int, DOW:int, vph:bigint",
    f"SELECT *, {week('cast(Hour as date)')} AS Week, {dow('Hour')} AS DOW FROM {VPH}",
)
def _(v):
    return vph(v)


@query(
    "a10_volume_per_15min", "SignalID, Timeperiod, vph:bigint",
    "SELECT SignalID, Timeperiod, sum(vol) AS vph FROM counts_15 WHERE CallPhase IN (2, 6) GROUP BY ALL",
)
def _(v):
    return A.volume_per_period(C.counts(v.event_log(), v.det_config(), minutes=15), minutes=15)


@query(
    "a11_daily_sum", "SignalID, Date, ~value, ~delta",
    f"""SELECT g.SignalID, g.Date, coalesce(p.value, 0) AS value, p.delta FROM (SELECT SignalID, cast(unnest(generate_series(cast(lo as timestamp), cast(hi as timestamp), interval 1 day)) as date) AS Date
    FROM (SELECT DISTINCT SignalID FROM daily_measure), (SELECT min(Date) AS lo, max(Date) AS hi FROM daily_measure)) g
    LEFT JOIN ({period_sum('daily_measure', 'Date')}) p USING (SignalID, Date)""",
)
def _(v):
    return A.daily_sum(v.daily_measure(), "value")


@query("a12_weekly_sum", "SignalID, Date, Week:int, ~value, ~delta", weekly_sum("daily_measure"))
def _(v):
    return A.weekly_sum(v.daily_measure(), "value")


@query("a13_weekly_avg", "SignalID, Date, Week:int, ~value, weight:bigint, ~delta", weekly_avg("daily_measure"))
def _(v):
    return A.weekly_avg(v.daily_measure(), "value", "weight", peak_only=False)


@query("a13_weekly_avg_peak", "SignalID, Date, Week:int, ~value, weight:bigint, ~delta", weekly_avg("hourly_measure", where=f"WHERE {peak('Date_Hour')}"))
def _(v):
    return A.weekly_avg(v.hourly_measure(), "value", "weight")


@query("a14_monthly_avg_weighted", "SignalID, Month, ~value, weight:bigint, ~delta", monthly_avg("daily_measure"))
def _(v):
    return A.monthly_avg(v.daily_measure(), "value", "weight")


@query("a14_monthly_avg_summed", "SignalID, Month, ~value, ~delta", monthly_avg("daily_measure", w=None))
def _(v):
    return A.monthly_avg(v.daily_measure(), "value")


@query("a15_weekly_by_hour", "SignalID, Hour, Week:int, ~value, ~delta", weekly_by_hour("hourly_measure"))
def _(v):
    return A.weekly_by_hour(_hours(v), "value")


@query("a16_avg_by_hour", "SignalID, CallPhase:int, Hour, Week:int, DOW:int, ~value, weight:bigint, ~delta", avg_by_hour("hourly_measure"))
def _(v):
    return A.avg_by_hour(v.hourly_measure(), "value", "weight")


@query("a17_monthly_by_hour", "SignalID, Hour, ~value, weight:bigint, ~delta", monthly_by_hour(HOURS))
def _(v):
    return A.monthly_by_hour(_hours(v), "value", "weight")


@query(
    "a18_summarize_by_peak", "SignalID, Date, Peak, ~sf_freq, cycles:bigint",
    f"""SELECT SignalID, Date, CASE WHEN {peak('Date_Hour')} THEN 'Peak' ELSE 'Off_Peak' END AS Peak, {wmean('value', 'weight')} AS sf_freq, sum(weight) AS cycles
    FROM hourly_measure GROUP BY ALL""",
)
def _(v):
    from phasewright.operators.measures import split_failures_by_peak

    return split_failures_by_peak(v.hourly_measure().withColumnsRenamed({"value": "sf_freq", "weight": "cycles"}))


@query(
    "a19_sum_by_period", "SignalID, CallPhase:int, Week:int, DOW:int, Timeperiod, ~vol, ~delta",
    f"""SELECT *, {delta('vol', 'SignalID, CallPhase, Week, DOW', 'Timeperiod')} AS delta FROM (SELECT SignalID, CallPhase, {week('cast(Timeperiod as date)')} AS Week,
    {dow('Timeperiod')} AS DOW, {hour('Timeperiod')} AS Timeperiod, sum(vol) AS vol FROM counts_15 GROUP BY ALL)""",
)
def _(v):
    return A.sum_by_period(C.counts(v.event_log(), v.det_config(), minutes=15), "vol")


@query(
    "a20_corridor_weekly_by_period", COR_COLS.format(p="Date") + ", Week:int",
    f"SELECT *, {week('Date')} AS Week FROM ({rollup('(' + weekly_avg('daily_measure') + ')', 'Date', 'value', 'weight')})",
)
def _(v):
    return A.corridor_by_date(A.weekly_avg(v.daily_measure(), "value", "weight", peak_only=False), v.corridors(), "value", "weight")


@query("a21_corridor_by_period", "Zone_Group, Corridor, Hour, ~vph, ones:bigint, ~delta", rollup("(" + period_sum(VPH, "Hour", "vph") + ")", "Hour", "vph"))
def _(v):
    return A.corridor_rollup(A.period_sum(vph(v), "vph", "Hour"), v.corridors(), "vph", period="Hour")


@query(
    "a22_corridor_by_date", COR_COLS.format(p="Date") + ", Week:int",
    f"SELECT *, {week('Date')} AS Week FROM ({rollup('(' + period_avg('daily_measure', 'Date') + ')', 'Date', 'value', 'weight')})",
)
def _(v):
    return A.corridor_by_date(A.daily_avg(v.daily_measure(), "value", "weight"), v.corridors(), "value", "weight")


@query(
    "a22_subcorridor_by_date", COR_COLS.format(p="Date"),
    rollup("(" + period_avg("daily_measure", "Date") + ")", "Date", "value", "weight", level="subcorridors"),
)
def _(v):
    return A.corridor_by_date(A.daily_avg(v.daily_measure(), "value", "weight"), K.subcorridor_view(v.corridors()), "value", "weight")


@query("a23_corridor_by_month", COR_COLS.format(p="Month"), rollup("(" + monthly_avg("daily_measure") + ")", "Month", "value", "weight"))
def _(v):
    return A.corridor_by_month(A.monthly_avg(v.daily_measure(), "value", "weight"), v.corridors(), "value", "weight")


@query(
    "a24_corridor_weekly_by_hour", "Zone_Group, Corridor, Hour, ~value, ones:bigint, ~delta",
    rollup("(" + weekly_by_hour("hourly_measure") + ")", "Hour", "value", keep=True),
)
def _(v):
    return A.corridor_by_hour(A.weekly_by_hour(_hours(v), "value"), v.corridors(), "value")


@query("a25_corridor_monthly_by_hour", COR_COLS.format(p="Hour"), rollup("(" + monthly_by_hour(HOURS) + ")", "Hour", "value", "weight", keep=True))
def _(v):
    return A.corridor_by_hour(A.monthly_by_hour(_hours(v), "value", "weight"), v.corridors(), "value", "weight")


MO_COR = rollup("(" + monthly_avg("daily_measure") + ")", "Month", "value", "weight")


def monthly_corridors(v):
    return A.corridor_by_month(A.monthly_avg(v.daily_measure(), "value", "weight"), v.corridors(), "value", "weight")


def quarterly(src: str, v: str, agg: str, w: str | None = None) -> str:
    tail = f", sum({w}) AS {w}" if w else ""
    return f"""SELECT *, {delta(v, 'Corridor, Zone_Group', 'Quarter')} AS delta FROM (SELECT Corridor, Zone_Group,
      extract(year from Month) || '.' || extract(quarter from Month) AS Quarter, {agg} AS {v}{tail} FROM ({src}) GROUP BY ALL)"""


@query("a26_quarterly_avg", "Corridor, Zone_Group, Quarter, ~value, weight:bigint, ~delta", quarterly(MO_COR, "value", wmean("value", "weight"), "weight"))
def _(v):
    return A.quarterly(monthly_corridors(v), "value", "weight")


@query("a26_quarterly_sum", "Corridor, Zone_Group, Quarter, ~value, ~delta", quarterly(MO_COR, "value", "sum(value)"))
def _(v):
    return A.quarterly(monthly_corridors(v), "value", operation="sum")


@query("a26_quarterly_latest", "Corridor, Zone_Group, Quarter, ~value, ~delta", quarterly(MO_COR, "value", "arg_max(value, Month)"))
def _(v):
    return A.quarterly(monthly_corridors(v), "value", "weight", "latest")


def signal_rows(sig: str, cor: str, per: str, v: str) -> str:
    return f"""SELECT h.Corridor AS Zone_Group, s.SignalID AS Corridor, coalesce(h.Description, s.SignalID) AS Description, s.{per}, s.{v}, s.delta
      FROM ({sig}) s LEFT JOIN corridors h USING (SignalID) UNION ALL
      SELECT Corridor, Corridor, Corridor, {per}, {v}, delta FROM ({cor}) WHERE Corridor IN (SELECT Corridor FROM corridors WHERE SignalID IN (SELECT SignalID FROM ({sig})))"""


@query("a27_signal_rows", "Zone_Group, Corridor, Description, Month, ~value, ~delta", signal_rows(monthly_avg("daily_measure"), MO_COR, "Month", "value"))
def _(v):
    return A.signal_rows(A.monthly_avg(v.daily_measure(), "value", "weight"), monthly_corridors(v), v.corridors())


METRIC = Metric("Value", "value", "m", weight="weight")
_DAILY = "(" + period_avg("daily_measure", "Date") + ")"
_DAILY_P = f"(SELECT *, 0 AS CallPhase, {week('Date')} AS Week FROM {_DAILY})"


def _bundle(v):
    daily = A.daily_avg(v.daily_measure(), "value", "weight").withColumn("CallPhase", F.lit(0)).withColumn("Week", X.week("Date"))
    return A.aggregate_plans(METRIC, stage(daily), v.corridors(), K.subcorridor_view(v.corridors()))


_AGG_MO = monthly_avg(_DAILY_P)
_AGG_WK = weekly_avg(_DAILY_P)
_AGG_SUB_MO = rollup("(" + _AGG_MO + ")", "Month", "value", "weight", level="subcorridors")


@query(
    "a28_aggregate_signal_week", "Zone_Group, Corridor, Date, ~value, ~delta",
    signal_rows(_AGG_WK, rollup("(" + _AGG_WK + ")", "Date", "value", "weight"), "Date", "value"),
)
def _(v):
    return _bundle(v)["sig_wk_m"]()


@query("a28_aggregate_subcorridor_month", COR_COLS.format(p="Month"), _AGG_SUB_MO)
def _(v):
    return _bundle(v)["sub_mo_m"]()


@query(
    "a28_aggregate_subcorridor_quarter", "Corridor, Zone_Group, Quarter, ~value, ~delta",
    quarterly(_AGG_SUB_MO, "value", "avg(value)"),
)
def _(v):
    return _bundle(v)["sub_qu_m"]()


# Detector uptime ------------------------------------------------------------------------------

DDU = """SELECT f.SignalID, f.CallPhase, f.Date, f.Timeperiod AS Date_Hour, CASE WHEN f.CallPhase IN (2, 6) THEN 'Setback' ELSE 'Presence' END AS setback,
  coalesce(sum(f.Good_Day), 0) / count(*) AS uptime, cast(count(*) as double) AS "all" FROM filtered_1h f ANTI JOIN (SELECT SignalID, Timeperiod FROM filtered_1h
  GROUP BY ALL HAVING coalesce(sum(vol), 0) = 0) z ON f.SignalID = z.SignalID AND f.Timeperiod = z.Timeperiod GROUP BY ALL"""


def ddu(v):
    return A.daily_detector_uptime(C.filter_counts(C.counts(v.event_log(), v.det_config()), v.det_config(), LOW_HOURLY))


@query("a29_daily_detector_uptime", "SignalID, CallPhase:int, Date, Date_Hour, setback, ~uptime, ~all", DDU)
def _(v):
    return ddu(v)


def _uptime_part(kind: str | None, s: str) -> str:
    f = f" FILTER (WHERE setback = '{kind}')" if kind else ""
    return f"""sum(uptime * "all"){f} / nullif(sum("all"){f}, 0) AS uptime{s}, sum("all"){f} AS all{s}"""


AVG_DDU = f"""SELECT *, {delta('uptime', S, 'Date')} AS delta FROM (SELECT SignalID, Date, {_uptime_part(None, '_x')}, {_uptime_part('Setback', '_sb')},
  {_uptime_part('Presence', '_pr')}, uptime_x AS uptime FROM ({DDU}) GROUP BY SignalID, Date)"""


@query(
    "a30_avg_daily_detector_uptime", "SignalID, Date, ~uptime, ~all, ~uptime_sb, ~all_sb, ~uptime_pr, ~all_pr, ~delta",
    f'SELECT *, all_x AS "all" FROM ({AVG_DDU})',
)
def _(v):
    return A.avg_daily_detector_uptime(ddu(v))


def _three(per: str, src: str, weighted: bool) -> str:
    def part(v, w):
        return rollup(f"(SELECT * FROM {src} WHERE {v} IS NOT NULL)", per, v, w)

    d = ", u.delta" if weighted else ""
    return f"""SELECT Zone_Group, Corridor, {per}, uptime_sb, uptime_pr, u.uptime{d} FROM (SELECT Zone_Group, Corridor, {per}, s.uptime_sb, p.uptime_pr FROM
      ({part('uptime_sb', 'all_sb')}) s FULL JOIN ({part('uptime_pr', 'all_pr')}) p USING (Zone_Group, Corridor, {per})) LEFT JOIN
      ({part('uptime', 'all_x' if weighted else 'ones')}) u USING (Zone_Group, Corridor, {per})"""


@query("a31_corridor_daily_detector_uptime", "Zone_Group, Corridor, Date, ~uptime_sb, ~uptime_pr, ~uptime", _three("Date", f"({AVG_DDU})", False))
def _(v):
    return A.corridor_daily_detector_uptime(stage(A.avg_daily_detector_uptime(ddu(v))), v.corridors())


@query(
    "a32_corridor_monthly_detector_uptime", "Zone_Group, Corridor, Month, ~uptime_sb, ~uptime_pr, ~uptime, ~delta",
    _three("Month", f"(SELECT *, {month('Date')} AS Month FROM ({AVG_DDU}))", True),
)
def _(v):
    return A.corridor_monthly_detector_uptime(stage(A.avg_daily_detector_uptime(ddu(v))), v.corridors())


_FLASH = f"(SELECT SignalID, {month('Date')} AS Date, 0 AS CallPhase, count(*) AS flash FROM daily_measure GROUP BY ALL)"


@query("a33_monthly_flash_events", "SignalID, Month, ~flash, ~delta", monthly_avg(_FLASH, "flash", None))
def _(v):
    return A.monthly_flash_events(v.daily_measure())


@query("a34_monthly_volume_by_hour", "SignalID, Hour, ~value", monthly_volume(HOURS))
def _(v):
    return A.monthly_volume_by_hour(_hours(v), "value")


@query("a35_monthly_by_hour_no_change", "SignalID, Hour, ~value, weight:bigint", monthly_by_hour("(" + avg_by_hour("hourly_measure") + ")"))
def _(v):
    return A.monthly_by_hour(A.avg_by_hour(v.hourly_measure(), "value", "weight"), "value", "weight", change=False)


_POD = "CASE WHEN extract(hour from Hour) IN (6, 7, 8, 9) THEN 'am' WHEN extract(hour from Hour) IN (15, 16, 17, 18, 19) THEN 'pm' END"


def _peaks(src: str, level: str) -> str:
    return f"""SELECT *, {delta('value', level + ', period_of_day', 'Month')} AS delta FROM (SELECT {level}, {_POD} AS period_of_day, cast(Hour as date) AS Month,
      avg(value) AS value, count(*) AS ones FROM ({src}) WHERE {_POD} IS NOT NULL GROUP BY ALL)"""


@query("a36_volume_at_peaks", "SignalID, period_of_day, Month, ~value, ones:bigint, ~delta", _peaks(monthly_volume(HOURS), "SignalID"))
def _(v):
    return A.volume_at_peaks(A.monthly_volume_by_hour(_hours(v), "value"), "value")


@query(
    "a37_corridor_at_peaks", "Zone_Group, Corridor, period_of_day, Month, ~value, ~delta",
    _peaks(rollup("(" + monthly_volume(HOURS) + ")", "Hour", "value", keep=True), "Zone_Group, Corridor"),
)
def _(v):
    cor = A.corridor_by_hour(A.monthly_volume_by_hour(_hours(v), "value"), v.corridors(), "value")
    return A.corridor_at_peaks(cor, "value")


# Thin bindings --------------------------------------------------------------------------------

_MID = "(SELECT * FROM {src} WHERE DOW IN (3, 4, 5))"
_NAMED = {
    "vpd": ("vpd", "daily_measure"), "papd": ("papd", "daily_measure"), "tp": ("vph", "daily_measure"), "aogd": ("aog", "hourly_measure"),
    "prd": ("pr", "hourly_measure"), "sfd": ("sf_freq", "hourly_measure"), "qsd": ("qs_freq", "hourly_measure"), "du": ("uptime", "hourly_measure"),
}


def _bind_sql(name: str) -> tuple[str, str]:
    kind, table = name.split("_")
    b = P.thin_bindings()[name]
    var, src = _NAMED[table]
    w = b["wt"]
    named = f"(SELECT * RENAME (value AS {var}{f', weight AS {chr(34)}{w}{chr(34)}' if w else ''}) FROM {src})"
    if b["midweek"]:
        named = _MID.format(src=named)
    wq = f'"{w}"' if w else None
    where = f"WHERE {peak('Date_Hour')}" if b.get("peak_only") else ""
    if kind == "hourly":
        return avg_by_hour(named, var, wq), f"SignalID, CallPhase:int, Hour, ~{var}, ~delta"
    if kind == "monthly":
        return monthly_avg(named, var, wq, where), f"SignalID, Month, ~{var}, ~delta"
    sql = weekly_avg(named, var, wq, where) if w else weekly_sum(named, var)
    if name == "weekly_du":
        sql = f"SELECT * REPLACE (coalesce({var}, 0) AS {var}) FROM ({sql})"
    return sql, f"SignalID, Date, Week:int, ~{var}, ~delta"


def _register_binding(name: str) -> None:
    sql, cols = _bind_sql(name)
    table = name.split("_")[1]
    var, src = _NAMED[table]
    wt = P.thin_bindings()[name]["wt"]

    @query(f"binding_{name}", cols, sql)
    def _(v):
        df = getattr(v, src)().withColumnRenamed("value", var)
        return P.bind(name, df.withColumnRenamed("weight", wt) if wt else df)


for _name in P.thin_bindings():
    _register_binding(_name)


# Calendar and completion ----------------------------------------------------------------------


@query("x01_week", "o_orderkey, Week:int", f"SELECT o_orderkey, {week('cast(o_orderdate as date)')} AS Week FROM orders")
def _(v):
    return v.table("orders").select("o_orderkey", X.week(F.to_date("o_orderdate")).alias("Week"))


@query(
    "x02_tuesday_of_week", "Week:int, Date",
    f"""SELECT DISTINCT Week, {tuesday('Week', '(SELECT min(Date) FROM daily_measure)')} AS Date FROM daily_measure""",
)
def _(v):
    d = v.daily_measure()
    first = d.agg(F.min("Date")).scalar()
    return d.select("Week").distinct().withColumn("Date", X.tuesday_of_week("Week", first))


@query(
    "x03_round_to_tuesday", "Date, Tuesday",
    "SELECT DISTINCT Date, Date + cast(2 - extract(dow from Date) as int) AS Tuesday FROM daily_measure",
)
def _(v):
    return v.daily_measure().select("Date", X.round_to_tuesday("Date").alias("Tuesday")).distinct()


@query("x04_most_recent_monday", "Date, Monday", "SELECT DISTINCT Date, cast(date_trunc('week', Date) as date) AS Monday FROM daily_measure")
def _(v):
    return v.daily_measure().select("Date", X.most_recent_monday("Date").alias("Monday")).distinct()


@query(
    "x05_run_length", "SignalID, CallPhase:int, Date, weight:bigint, run:bigint",
    """SELECT *, row_number() OVER (PARTITION BY SignalID, CallPhase, island ORDER BY Date) AS run FROM (SELECT *, sum(c) OVER (PARTITION BY SignalID, CallPhase ORDER BY Date)
    AS island FROM (SELECT *, CASE WHEN weight = lag(weight) OVER (PARTITION BY SignalID, CallPhase ORDER BY Date) THEN 0 ELSE 1 END AS c FROM daily_measure))""",
)
def _(v):
    return R.run_length(v.daily_measure(), ["SignalID", "CallPhase"], "Date", "weight", "run")


@query(
    "x06_zero_streak_id", "SignalID, CallPhase:int, Date, streak:bigint",
    """SELECT SignalID, CallPhase, Date, CASE WHEN w > 0 THEN NULL ELSE last_value(CASE WHEN w > 0 THEN i END IGNORE NULLS) OVER (PARTITION BY SignalID, CallPhase ORDER BY Date) END AS streak
    FROM (SELECT *, weight - 1 AS w, row_number() OVER (PARTITION BY SignalID, CallPhase ORDER BY Date) AS i FROM daily_measure)""",
)
def _(v):
    d = v.daily_measure().withColumn("w", F.col("weight") - 1)
    return R.zero_streak_id(d, ["SignalID", "CallPhase"], "Date", "w", "streak")


@query(
    "x07_month_labels", "SignalID, label",
    """SELECT SignalID, strftime(unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), interval 1 month)), '%Y-%m') AS label
    FROM (SELECT SignalID, cast(min(Date) as timestamp) AS lo, cast(max(Date) as timestamp) AS hi FROM daily_measure GROUP BY ALL)""",
)
def _(v):
    span = v.daily_measure().groupBy("SignalID").agg(F.min("Date").alias("lo"), F.max("Date").alias("hi"))
    return span.select("SignalID", F.explode(X.month_labels("lo", "hi")).alias("label"))


@query("x09_floor_15min", "event_id, t", f"SELECT event_id, {quarter_hour('ts')} AS t FROM events")
def _(v):
    return v.table("events").select("event_id", X.floor_minutes("ts", 15).alias("t"))


@query(
    "x10_month_and_year_hour", "event_id, mh, yh",
    "SELECT event_id, date_trunc('month', ts) + (ts - date_trunc('day', ts)) AS mh, date_trunc('year', ts) + (ts - date_trunc('day', ts)) AS yh FROM events",
)
def _(v):
    return v.table("events").select("event_id", X.onto_month_start("ts").alias("mh"), X.onto_year_start("ts").alias("yh"))


@query("x11_peak_hours", "is_peak, n:bigint", f"SELECT extract(hour from ts) IN {PEAK} AS is_peak, count(*) AS n FROM events GROUP BY ALL")
def _(v):
    return v.table("events").groupBy(X.is_peak("ts").alias("is_peak")).agg(F.count("*").alias("n"))


@query(
    "x12_complete", "SignalID, CallPhase:int, Date, weight:bigint",
    """SELECT g.SignalID, g.CallPhase, g.Date, coalesce(d.weight, 0) AS weight FROM (SELECT * FROM (SELECT DISTINCT SignalID, CallPhase FROM daily_measure),
    (SELECT DISTINCT Date FROM daily_measure)) g LEFT JOIN daily_measure d USING (SignalID, CallPhase, Date)""",
)
def _(v):
    return R.complete_seen(v.daily_measure().select("SignalID", "CallPhase", "Date", "weight"), ["SignalID", "CallPhase"], ["Date"], {"weight": 0})


@query(
    "x13_local_and_utc", "event_id, utc, back",
    "SELECT event_id, ts + interval 5 hour AS utc, ts AS back FROM events",
)
def _(v):
    # January has no clock change in the zone.
    utc = X.local_to_utc("ts", "America/New_York")
    return v.table("events").select("event_id", utc.alias("utc"), X.utc_to_local(utc, "America/New_York").alias("back"))


@query(
    "x15_text_cleanup", "p_partkey, label",
    "SELECT p_partkey, trim(regexp_replace(p_name, '[aeiou]+', '*', 'g')) || ' | ' || upper(p_brand) AS label FROM part WHERE regexp_matches(p_name, '^(red|small)')",
)
def _(v):
    p = v.table("part").where(F.col("p_name").rlike("^(red|small)"))
    return p.select("p_partkey", F.concat_ws(" | ", F.trim(F.regexp_replace("p_name", "[aeiou]+", "*")), F.upper("p_brand")).alias("label"))


