"""Daily and period measures."""

from pyspark.sql import functions as F

from checks.q_counts import LOW_HOURLY
from checks.registry import query
from checks.views_sql import dow, hour, plus, quarter_hour, secs, week, wmean
from phasewright.functions.calendar import floor_hour, month_of
from phasewright.functions.sketches import rank_error, rank_errors
from phasewright.functions.stats import wmean as weighted
from phasewright.operators import counts as C
from phasewright.operators import detectors as K
from phasewright.operators import measures as M
from phasewright.operators import pedestrian as PB
from phasewright.plans.daily import event_measures
from phasewright.session import stage


def _filtered(v):
    return C.filter_counts(C.counts(v.event_log(), v.det_config()), v.det_config(), LOW_HOURLY)


# Uptime ---------------------------------------------------------------------------------------

_MINUTES = """SELECT DISTINCT SignalID, Date, t FROM (SELECT SignalID, Date, date_trunc('minute', Timestamp) AS t FROM event_log UNION ALL
  SELECT SignalID, Date, unnest([cast(Date as timestamp), cast(Date as timestamp) + to_milliseconds(86399900)]) FROM
  (SELECT DISTINCT SignalID, Date FROM event_log))"""


def _up(src: str, by: str) -> str:
    return f"""SELECT {by}, 1 - sum(CASE WHEN g > 15 THEN g ELSE 0 END) / 1440 AS uptime FROM (SELECT *,
      date_diff('microsecond', lag(t) OVER (PARTITION BY {by} ORDER BY t), t) / 6e7 AS g FROM ({src})) GROUP BY {by}"""


SIGNAL_UP, SYSTEM_UP = _up(_MINUTES, "SignalID, Date"), _up(f"SELECT DISTINCT Date, t FROM ({_MINUTES})", "Date")


@query("m01_uptime_signal", "SignalID, Date, ~uptime", SIGNAL_UP)
def _(v):
    return M.uptime(v.event_log())[0]


@query("m01_uptime_system", "Date, ~uptime_all", f"SELECT Date, uptime AS uptime_all FROM ({SYSTEM_UP})")
def _(v):
    return M.uptime(v.event_log())[1]


@query(
    "m02_comm_uptime", "SignalID, CallPhase:int, Date, Date_Hour, DOW:int, Week:int, ~uptime",
    f"""SELECT SignalID, 0 AS CallPhase, s.Date, cast(s.Date as timestamp) AS Date_Hour, {dow('s.Date')} AS DOW, {week('s.Date')} AS Week,
    s.uptime + (1 - a.uptime) AS uptime FROM ({SIGNAL_UP}) s LEFT JOIN ({SYSTEM_UP}) a ON s.Date = a.Date""",
)
def _(v):
    return M.comm_uptime(v.event_log())


_DET_UP = """SELECT g.SignalID, g.Detector, g.Date, f.Good_Day FROM (SELECT SignalID, Detector, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) AS Date
  FROM (SELECT DISTINCT SignalID, Detector FROM filtered_1h), (SELECT min(Date) AS lo, max(Date) AS hi FROM filtered_1h)) g
  LEFT JOIN (SELECT DISTINCT SignalID, Detector, Date, Good_Day FROM filtered_1h) f USING (SignalID, Detector, Date)"""


@query("m03_detector_uptime", "SignalID, Detector:int, Date, Good_Day:int", _DET_UP)
def _(v):
    return M.detector_uptime(_filtered(v))


@query("m04_bad_detectors", "SignalID, Detector:int, Date, Good_Day:int", f"SELECT * FROM ({_DET_UP}) WHERE Good_Day = 0")
def _(v):
    return M.bad_detectors(_filtered(v))


@query(
    "m30_comm_quality_uptime", "SignalID, CallPhase:int, Date, DOW:int, Week:int, ~uptime",
    f"""SELECT AssetNum AS SignalID, 0 AS CallPhase, Date, {dow('Date')} AS DOW, {week('Date')} AS Week, AvgQuality / 100 AS uptime
    FROM comm_quality q JOIN corridors c ON q.AssetNum = c.SignalID WHERE CSDATE = Date AND Date >= c."Asof" """,
)
def _(v):
    return M.comm_quality_uptime(v.comm_quality(), v.corridors())


# Volumes --------------------------------------------------------------------------------------


def _vpd(src: str, name: str, where: str = "") -> str:
    return f"""SELECT *, {dow('Date')} AS DOW, {week('Date')} AS Week FROM (SELECT SignalID, CallPhase, cast(Timeperiod as date) AS Date,
      sum(vol) AS {name} FROM {src} {where} GROUP BY ALL)"""


@query(
    "m06_volume_per_day", "SignalID, CallPhase:int, Date, DOW:int, Week:int, vpd:bigint", _vpd("counts_1h", "vpd", "WHERE CallPhase IN (2, 6)"),
)
def _(v):
    return M.volume_per_day(C.counts(v.event_log(), v.det_config()))


@query("m06_ped_actuations_per_day", "SignalID, CallPhase:int, Date, DOW:int, Week:int, vpd:bigint", _vpd("counts_ped_1h", "vpd"))
def _(v):
    return M.volume_per_day(C.counts(v.event_log(), v.ped_config(), code=90), phases=None)


@query(
    "m07_throughput", "SignalID, CallPhase:int, Date, DOW:int, Week:int, ~vph",
    f"""SELECT *, 0 AS CallPhase, {dow('Date')} AS DOW, {week('Date')} AS Week FROM (SELECT SignalID, cast(Timeperiod as date) AS Date,
    quantile_cont(s, 0.95) * 4 AS vph FROM (SELECT SignalID, Timeperiod, sum(vol) AS s FROM counts_15 GROUP BY ALL) GROUP BY ALL)""",
)
def _(v):
    return M.throughput(C.counts(v.event_log(), v.det_config(), minutes=15))


@query(
    "m07_monthly_throughput_from_sketches", "SignalID, Period, n:bigint, within",
    "SELECT SignalID, cast(date_trunc('month', Timeperiod) as date) AS Period, count(DISTINCT Timeperiod) AS n, true AS within FROM counts_15 GROUP BY ALL",
)
def _(v):
    counted = stage(C.counts(v.event_log(), v.det_config(), minutes=15))
    monthly = stage(M.throughput_from_sketches(stage(M.throughput_sketches(counted)), month_of("Date")))
    exact = counted.groupBy("SignalID", "Timeperiod").agg((F.sum("vol") * 4.0).alias("vph")).withColumn("Period", month_of("Timeperiod"))
    errors = rank_errors(exact, monthly.drop("n"), ["SignalID", "Period"], "vph", "vph", 0.95)
    return monthly.select("SignalID", "Period", "n").join(errors.drop("n"), ["SignalID", "Period"]).withColumn("within", F.col("error") <= rank_error(200))


# Arrivals on green ----------------------------------------------------------------------------


def aog_sql(minutes: int) -> str:
    fl = hour if minutes == 60 else quarter_hour
    de = """SELECT DISTINCT d.* FROM detections d SEMI JOIN (SELECT * FROM det_config WHERE DetectionTypeDesc LIKE '%Advanced Count%') k
      ON d.SignalID = k.SignalID AND d.Detector = k.Detector"""
    line = f"""SELECT SignalID, Phase, Date, t, last_value(code IGNORE NULLS) OVER (PARTITION BY SignalID, Phase, Date ORDER BY t, code NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS code, lead(t) OVER (PARTITION BY SignalID, Phase, Date ORDER BY t, code NULLS LAST) AS nxt
      FROM (SELECT DISTINCT SignalID, Phase, Date, PhaseStart AS t, EventCode AS code FROM ({de}) UNION ALL
      SELECT SignalID, Phase, Date, unnest(generate_series(cast(Date as timestamp), cast(Date as timestamp) + interval 1 day - interval {minutes} minute,
      interval {minutes} minute)), NULL FROM (SELECT DISTINCT SignalID, Phase, Date FROM ({de})))"""
    return f"""SELECT a.*, r.Green_Duration, r.Duration, r.gC, a.AOG / nullif(r.gC, 0) AS pr FROM (
      SELECT SignalID, Phase, Date, {fl('DetTimeStamp')} AS Hour, count(*) FILTER (WHERE EventCode = 1) AS Green_Arrivals, count(*) AS All_Arrivals,
      count(*) FILTER (WHERE EventCode = 1) / count(*) AS AOG FROM ({de}) GROUP BY ALL HAVING count(*) FILTER (WHERE EventCode = 1) > 0) a
      LEFT JOIN (SELECT *, Green_Duration / nullif(Duration, 0) AS gC FROM (SELECT SignalID, Phase, Date, {fl('t')} AS Hour,
        coalesce(sum({secs('t', 'nxt')}) FILTER (WHERE code = 1), 0) AS Green_Duration, coalesce(sum({secs('t', 'nxt')}), 0) AS Duration
        FROM ({line}) WHERE code IS NOT NULL GROUP BY ALL HAVING bool_or(code = 1))) r
      USING (SignalID, Phase, Date, Hour)"""


AOG_COLS = "SignalID, Phase:int, Date, Hour, Green_Arrivals:bigint, All_Arrivals:bigint, ~AOG, ~Green_Duration, ~Duration, ~gC, ~pr"


@query("m22_arrivals_on_green", AOG_COLS, aog_sql(60))
def _(v):
    return M.arrivals_on_green(v.stored_tables()[2], v.det_config())


@query("m23_arrivals_on_green_15min", AOG_COLS, aog_sql(15))
def _(v):
    return M.arrivals_on_green(v.stored_tables()[2], v.det_config(), minutes=15)


@query(
    "m08_daily_aog_by_phase", "SignalID, CallPhase:int, Date, ~aog, vol:bigint",
    f"""SELECT SignalID, CallPhase, Date, {wmean('value', 'weight')} AS aog, sum(weight) AS vol FROM hourly_measure
    WHERE DOW IN (3, 4, 5) AND extract(hour from Date_Hour) IN (6, 7, 8, 9, 15, 16, 17, 18, 19) GROUP BY ALL""",
)
def _(v):
    return M.daily_aog_by_phase(v.hourly_measure().withColumnsRenamed({"value": "aog", "weight": "vol"}))


@query(
    "m09_daily_progression", "SignalID, CallPhase:int, Date, DOW:int, Week:int, ~pr, vol:bigint",
    f"SELECT SignalID, CallPhase, Date, DOW, Week, {wmean('value', 'weight')} AS pr, sum(weight) AS vol FROM hourly_measure GROUP BY ALL",
)
def _(v):
    return M.daily_progression(v.hourly_measure().withColumnsRenamed({"value": "pr", "weight": "vol"}))


@query("m25_weighted_mean", "SignalID, ~value", f"SELECT SignalID, {wmean('value', 'weight')} AS value FROM hourly_measure GROUP BY ALL")
def _(v):
    return v.hourly_measure().groupBy("SignalID").agg(weighted("value", "weight").alias("value"))


# Split failures -------------------------------------------------------------------------------


def occ_sql(intervals: str, de: str) -> str:
    return f"""SELECT i.SignalID, i.Phase, i.Date, i.CycleStart, coalesce(o.occ, 0) AS occ FROM (SELECT DISTINCT SignalID, Phase, Date, CycleStart FROM ({intervals})) i
      LEFT JOIN (SELECT SignalID, Phase, Date, CycleStart, max(occ) AS occ FROM (SELECT i.SignalID, i.Phase, i.Date, i.CycleStart, d.Detector,
        sum({secs('greatest(i.s, d.DetOn)', 'least(i.e, d.DetOff)')}) / nullif(max({secs('i.s', 'i.e')}), 0) AS occ
        FROM ({intervals}) i JOIN ({de}) d ON i.SignalID = d.SignalID AND i.Phase = d.Phase AND i.Date = d.Date AND d.DetOn <= i.e AND d.DetOff >= i.s
        WHERE i.s <= i.e GROUP BY ALL) GROUP BY ALL) o USING (SignalID, Phase, Date, CycleStart)"""


def _de(phases: str, kind: str) -> str:
    return f"""SELECT d.SignalID, d.Phase, d.Date, d.Detector, DetTimeStamp AS DetOn, {plus('DetTimeStamp', 'DetDuration')} AS DetOff FROM detections d
      SEMI JOIN (SELECT * FROM det_config WHERE DetectionTypeDesc LIKE '%{kind}%') k ON d.SignalID = k.SignalID AND d.Phase = k.CallPhase
      AND d.Detector = k.Detector WHERE d.Phase IN {phases}"""


_GREEN = "SELECT SignalID, Phase, Date, CycleStart, PhaseStart AS s, PhaseEnd AS e FROM cycles WHERE EventCode = 1 AND Phase IN (2, 4, 6, 8)"
_RED = f"SELECT SignalID, Phase, Date, CycleStart, PhaseStart AS s, PhaseStart + interval 1200 second AS e FROM cycles WHERE EventCode = 9 AND Phase IN (2, 4, 6, 8)"
_SF_DE = _de("(2, 4, 6, 8)", "Stop Bar Presence")


@query("m10_occupancy", "SignalID, Phase:int, Date, CycleStart, ~occ", occ_sql(_GREEN, _SF_DE))
def _(v):
    _, cycles, detections = v.stored_tables()
    presence = K.for_split_failures(v.det_config()).select("SignalID", F.col("CallPhase").alias("Phase"), "Detector")
    de = detections.join(presence, ["SignalID", "Phase", "Detector"], "left_semi").select(
        "SignalID", "Phase", "Date", "Detector", F.col("DetTimeStamp").alias("DetOn"),
        M.plus_seconds("DetTimeStamp", F.col("DetDuration")).alias("DetOff"),
    )
    green = cycles.where("EventCode = 1 and Phase in (2, 4, 6, 8)").select(
        "SignalID", "Phase", "Date", "CycleStart", F.col("PhaseStart").alias("IntervalStart"), F.col("PhaseEnd").alias("IntervalEnd")
    )
    return M.occupancy(de, green, bin_seconds=3600)


def sf_sql(fl) -> str:
    per_cycle = f"""SELECT SignalID, Phase, Date, CycleStart, cast(coalesce(g.occ, 0) > 0.2 AND coalesce(r.occ, 0) > 0.2 as int) AS sf
      FROM ({occ_sql(_GREEN, _SF_DE)}) g FULL JOIN ({occ_sql(_RED, _SF_DE)}) r USING (SignalID, Phase, Date, CycleStart)"""
    return f"""SELECT SignalID, CallPhase, Date_Hour, cast(Date_Hour as date) AS Date, {dow('Date_Hour')} AS DOW, {week('cast(Date_Hour as date)')} AS Week,
      sf, cycles, sf / cycles AS sf_freq FROM (SELECT SignalID, Phase AS CallPhase, {fl('CycleStart')} AS Date_Hour, sum(sf) AS sf, count(*) AS cycles
      FROM (WITH p AS ({per_cycle}) SELECT SignalID, Phase, CycleStart, sf FROM p UNION ALL
      SELECT SignalID, 0, CycleStart, max(sf) FROM p GROUP BY SignalID, Date, CycleStart) GROUP BY ALL)"""


SF_COLS = "SignalID, CallPhase:int, Date_Hour, Date, DOW:int, Week:int, sf:int, cycles:bigint, ~sf_freq"
_SF_ARGS = {"first_seconds_of_red": 1200, "phases": (2, 4, 6, 8), "threshold": 0.2, "bin_seconds": 3600}


@query("m11_split_failures_hour", SF_COLS, sf_sql(hour))
def _(v):
    _, cycles, detections = v.stored_tables()
    return M.split_failures(cycles, detections, K.for_split_failures(v.det_config()), **_SF_ARGS)


@query("m11_split_failures_15min", SF_COLS, sf_sql(quarter_hour))
def _(v):
    _, cycles, detections = v.stored_tables()
    return M.split_failures(cycles, detections, K.for_split_failures(v.det_config()), minutes=15, **_SF_ARGS)


@query(
    "m12_split_failures_by_peak", "SignalID, Date, Peak, ~sf_freq, cycles:bigint",
    f"""SELECT SignalID, Date, CASE WHEN extract(hour from Date_Hour) IN (6, 7, 8, 9, 15, 16, 17, 18, 19) THEN 'Peak' ELSE 'Off_Peak' END AS Peak,
    {wmean('value', 'weight')} AS sf_freq, sum(weight) AS cycles FROM hourly_measure GROUP BY ALL""",
)
def _(v):
    return M.split_failures_by_peak(v.hourly_measure().withColumnsRenamed({"value": "sf_freq", "weight": "cycles"}))


def red_start_sql() -> str:
    pre, post = secs("r.PhaseStart", "d.DetOn"), secs("r.PhaseStart", "d.DetOff")
    return f"""SELECT SignalID, Phase, {hour('PhaseStart')} AS Hour, sum(f) AS sf, count(*) AS cycles, sum(f) / count(*) AS sf_freq FROM (
      SELECT r.SignalID, r.Phase, r.PhaseStart, cast(coalesce({pre} < 0 AND {post} > 10 AND {post} - {pre} < 7200, false) as int) AS f
      FROM (SELECT DISTINCT SignalID, Date, Phase, PhaseStart FROM cycles WHERE EventCode = 9) r ASOF LEFT JOIN (
        SELECT SignalID, Date, Phase, DetOff, max(DetOn) AS DetOn FROM (SELECT SignalID, Date, Phase, DetTimeStamp AS DetOn,
        {plus('DetTimeStamp', 'DetDuration')} AS DetOff FROM detections) GROUP BY ALL) d
      ON r.SignalID = d.SignalID AND r.Date = d.Date AND r.Phase = d.Phase AND r.PhaseStart <= d.DetOff) GROUP BY ALL"""


RED_COLS = "SignalID, Phase:int, Hour, sf:int, cycles:bigint, ~sf_freq"


@query("m28_split_failures_red_start", RED_COLS, red_start_sql())
def _(v):
    _, cycles, detections = v.stored_tables()
    return M.split_failures_red_start(cycles, detections, max_span=7200, side_phases_only=False)


@query(
    "m13_shape_split_failures", "SignalID, CallPhase:int, Date, Date_Hour, DOW:int, Week:int, sf:int, cycles:bigint, ~sf_freq",
    f"""SELECT SignalID, Phase AS CallPhase, cast(Hour as date) AS Date, Hour AS Date_Hour, {dow('Hour')} AS DOW, {week('cast(Hour as date)')} AS Week,
    sf, cycles, sf_freq FROM ({red_start_sql()})""",
)
def _(v):
    _, cycles, detections = v.stored_tables()
    return M.shape_split_failures(M.split_failures_red_start(cycles, detections, max_span=7200, side_phases_only=False))


# Queue spillback ------------------------------------------------------------------------------


def qs_sql(fl) -> str:
    de = """SELECT d.* FROM detections d SEMI JOIN (SELECT * FROM det_config WHERE DetectionTypeDesc LIKE '%Advanced Count%'
      OR DetectionTypeDesc LIKE '%Advanced Speed%') k ON d.SignalID = k.SignalID AND d.Phase = k.CallPhase AND d.Detector = k.Detector"""
    return f"""SELECT *, {dow('Date')} AS DOW, {week('Date')} AS Week, qs / cycles AS qs_freq FROM (SELECT SignalID, Phase AS CallPhase, Date,
      {fl('CycleStart')} AS Date_Hour, count(*) FILTER (WHERE occ > 1800) AS qs, count(*) AS cycles FROM (
      SELECT Date, SignalID, CycleStart, Phase, max(occ) AS occ FROM (SELECT Date, SignalID, CycleStart, Phase, Detector,
      quantile_cont(DetDuration, 0.95) AS occ FROM ({de}) GROUP BY ALL) GROUP BY ALL) GROUP BY ALL)"""


QS_COLS = "SignalID, CallPhase:int, Date, Date_Hour, DOW:int, Week:int, qs:int, cycles:int, ~qs_freq"


@query("m14_queue_spillback_hour", QS_COLS, qs_sql(hour))
def _(v):
    return M.queue_spillback(v.stored_tables()[2], K.for_spillback(v.det_config()), threshold=1800)


@query("m14_queue_spillback_15min", QS_COLS, qs_sql(quarter_hour))
def _(v):
    return M.queue_spillback(v.stored_tables()[2], K.for_spillback(v.det_config()), minutes=15, threshold=1800)


# Pedestrians ----------------------------------------------------------------------------------

_PAPH = f"""SELECT SignalID, Detector, CallPhase, Date, Hour, {{v}} AS paph FROM (SELECT SignalID, EventParam AS Detector, EventParam AS CallPhase, Date,
  {hour('Timestamp')} AS Hour, count(*) AS n, max(extract(minute from Timestamp)) AS mi FROM event_log WHERE EventCode = 90 GROUP BY ALL)"""
# Presses are scaled up so that some input-days are implausible.
_SCALED = _PAPH.format(v="n * CASE WHEN mi >= 50 THEN 700 WHEN mi >= 40 THEN 61 ELSE 1 END")


def _paph(v):
    hours = v.event_log().where("EventCode = 90").groupBy(
        "SignalID", F.col("EventParam").alias("Detector"), F.col("EventParam").alias("CallPhase"), "Date", floor_hour("Timestamp").alias("Hour")
    ).agg(F.count("*").alias("n"), F.max(F.minute("Timestamp")).alias("mi"))
    return hours.withColumn("paph", F.col("n") * F.when(F.col("mi") >= 50, 700).when(F.col("mi") >= 40, 61).otherwise(1))


_IN = "SignalID, Detector, CallPhase"
_TOO_HIGH = f"""WITH p AS ({_SCALED}), full_day AS (SELECT i.*, d.Date, d.Hour, coalesce(p.paph, 0) AS paph FROM (SELECT DISTINCT {_IN} FROM p) i,
  (SELECT DISTINCT Date, Hour FROM p) d LEFT JOIN p ON p.SignalID = i.SignalID AND p.Detector = i.Detector AND p.CallPhase = i.CallPhase AND p.Hour = d.Hour),
  q AS (SELECT * FROM p WHERE extract(hour from Hour) BETWEEN 6 AND 22), day_time AS (SELECT i.*, d.Date, coalesce(q.paph, 0) AS paph FROM
  (SELECT DISTINCT {_IN} FROM q) i, (SELECT DISTINCT Date, Hour FROM q) d LEFT JOIN q ON q.SignalID = i.SignalID AND q.Detector = i.Detector
  AND q.CallPhase = i.CallPhase AND q.Hour = d.Hour)
  SELECT DISTINCT {_IN}, Date, true AS toohigh FROM (
  SELECT {_IN}, Date FROM day_time GROUP BY ALL HAVING avg(paph) > 600 OR stddev_samp(paph) > 9000
  UNION ALL SELECT {_IN}, Date FROM p WHERE extract(hour from Hour) < 6 GROUP BY ALL HAVING max(paph) > 300 OR coalesce(list_sort(list(paph), 'DESC')[3], 0) > 60
  UNION ALL SELECT {_IN}, Date FROM (SELECT *, list_sort(list(paph) OVER (PARTITION BY SignalID, Hour ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 'DESC')[2] AS s2 FROM full_day)
  GROUP BY ALL HAVING count(*) FILTER (WHERE paph > 300 AND paph > greatest(1, s2) * 100) >= 4)"""


@query("m15_presses_too_high", f"SignalID, Detector:int, CallPhase:int, Date, toohigh", _TOO_HIGH)
def _(v):
    return PB.presses_too_high(_paph(v), "2024-01-01")


def _papd(v):
    return v.event_log().where("EventCode = 90").groupBy(
        "SignalID", F.col("EventParam").alias("Detector"), F.col("EventParam").alias("CallPhase"), "Date"
    ).agg(F.count("*").alias("papd"))


_PAPD_SQL = "SELECT SignalID, EventParam AS Detector, EventParam AS CallPhase, Date, count(*) AS papd FROM event_log WHERE EventCode = 90 GROUP BY ALL"


def gamma_sql(src: str, by: str) -> str:
    """Chance of at most one press: the power series of the incomplete gamma function."""
    return f"""SELECT {by}, CASE WHEN mx = 0 OR v = 0 THEN 1 ELSE list_sum([exp((m * m / v + i) * ln(m / v) - m / v - lgamma(m * m / v + i + 1)) for i in range(0, 300)]) END AS p0
      FROM (SELECT {by}, avg(papd) AS m, var_pop(papd) AS v, max(papd) AS mx FROM {src} GROUP BY ALL HAVING count(*) > 2)"""


_GRID = f"""SELECT i.*, d.Date, coalesce(p.papd, 0) AS papd, extract(dow from d.Date) BETWEEN 1 AND 5 AS weekday FROM (SELECT DISTINCT {_IN} FROM ({_PAPD_SQL})) i,
  (SELECT unnest(generate_series(date '2023-08-01', date '2024-02-04', interval 1 day))::date AS Date) d LEFT JOIN ({_PAPD_SQL}) p ON p.SignalID = i.SignalID AND p.Detector = i.Detector AND p.Date = d.Date"""
_PED_UP = f"""WITH g AS ({_GRID}), k AS (SELECT *, row_number() OVER w AS idx FROM g WINDOW w AS (PARTITION BY {_IN} ORDER BY Date)),
  s AS (SELECT *, CASE WHEN papd > 0 THEN NULL ELSE last_value(CASE WHEN papd > 0 THEN idx END IGNORE NULLS) OVER (PARTITION BY {_IN} ORDER BY Date) END AS streak FROM k),
  later AS (SELECT * FROM s WHERE Date >= date '2024-01-01'), f AS ({gamma_sql('later', _IN + ', weekday')}),
  r AS (SELECT s.*, CASE WHEN streak IS NULL THEN 0 WHEN bool_or(p0 IS NULL) OVER w THEN NULL ELSE 1 - product(p0) OVER w END AS problow
    FROM later s LEFT JOIN f USING ({_IN}, weekday) WINDOW w AS (PARTITION BY {_IN}, streak)),
  h AS (SELECT r.*, t.toohigh IS NOT NULL AS high FROM r LEFT JOIN (SELECT * FROM ({_TOO_HIGH.replace('WITH p AS', 'WITH pz AS (' + _SCALED + "), p AS (SELECT * FROM pz WHERE Date >= date '2024-01-08'), pq AS", 1)})) t
    USING ({_IN}, Date) WHERE r.Date >= date '2024-01-08')
  SELECT {_IN}, Date, papd, problow, cast(high as int) AS probhigh, CASE WHEN problow > 0.99 OR high THEN 0 WHEN NOT (problow > 0.99 OR high) THEN 1 END AS uptime FROM h"""


@query("m16_low_press_probability", "SignalID, Detector:int, CallPhase:int, ~p0", gamma_sql(f"({_PAPD_SQL})", _IN))
def _(v):
    return PB.low_press_probability(_papd(v), PB.INPUT)


@query("m17_ped_uptime", "SignalID, Detector:int, CallPhase:int, Date, papd:bigint, ~problow, probhigh:int, uptime:int", _PED_UP)
def _(v):
    return PB.ped_uptime(_papd(v), _paph(v), v.corridors(), "2024-01-08", "2024-01-01", "2024-02-04")


@query("m05_bad_ped_inputs", "SignalID, Detector:int, Date", f"SELECT * FROM ({_PED_UP}) WHERE uptime = 0")
def _(v):
    return M.bad_ped_inputs(PB.ped_uptime(_papd(v), _paph(v), v.corridors(), "2024-01-08", "2024-01-01", "2024-02-04"))



@query(
    "m18_ped_count_repair", "SignalID, Detector:int, CallPhase:int, Date, papd:bigint",
    f"""SELECT p.SignalID, p.Detector, p.CallPhase, p.Date, CASE WHEN b.SignalID IS NOT NULL THEN floor(avg(CASE WHEN b.SignalID IS NULL THEN papd END)
    OVER (PARTITION BY p.SignalID, p.Detector, p.CallPhase, date_trunc('month', p.Date))) ELSE papd END AS papd FROM ({_PAPD_SQL}) p
    LEFT JOIN (SELECT DISTINCT SignalID, Detector, Date FROM ({_TOO_HIGH})) b USING (SignalID, Detector, Date)""",
)
def _(v):
    return M.ped_count_repair(_papd(v), PB.presses_too_high(_paph(v), "2024-01-01"))


_PED = f"""WITH e AS (SELECT SignalID, Date, Timestamp, EventCode, EventParam AS Phase, last_value(CASE WHEN EventCode = 132 THEN EventParam END IGNORE NULLS)
  OVER (PARTITION BY SignalID, Date ORDER BY Timestamp RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cl,
  max(CASE WHEN EventCode = 132 THEN EventParam END) OVER (PARTITION BY SignalID, Date) AS mx FROM {{log}} WHERE EventCode IN (45, 21, 22, 132)),
  r AS (SELECT *, CASE WHEN coalesce(mx, 0) = 0 THEN 'Free' ELSE 'Coordinated' END AS Pattern FROM e WHERE EventCode <> 132),
  n AS (SELECT *, lead(EventCode) OVER w AS nc, lead(Timestamp) OVER w AS nt FROM r WHERE Pattern = 'Free' OR coalesce(cl, 0) <> 0
    WINDOW w AS (PARTITION BY SignalID, Phase, Date ORDER BY Timestamp, EventCode)),
  d AS (SELECT *, {secs('Timestamp', 'nt')} AS delay FROM n WHERE nc = 21 AND ((Pattern = 'Free' AND EventCode = 45) OR (Pattern = 'Coordinated' AND EventCode = 22)))
  SELECT SignalID, Date, Pattern, sum(m * c) / sum(c) AS Avg_Max_Ped_Delay, sum(c) AS Events FROM (SELECT SignalID, Date, Pattern, Phase, avg(delay) AS m,
  count(*) AS c FROM d WHERE CASE WHEN Pattern = 'Free' THEN delay <= 30000 ELSE delay <= cl END GROUP BY ALL) GROUP BY ALL"""
PED_COLS = "SignalID, Date, Pattern, ~Avg_Max_Ped_Delay, Events:bigint"


def _scaled_cycles(log, factor: int = 100):
    """Cycle lengths in the scale of the compressed day."""
    return log.withColumn("EventParam", F.when(F.col("EventCode") == 132, F.col("EventParam") * factor).otherwise(F.col("EventParam")))


_DAY100 = "(SELECT SignalID, Date, Timestamp, EventCode, CASE WHEN EventCode = 132 THEN EventParam * 100 ELSE EventParam END AS EventParam FROM event_log_day)"


@query("m19_ped_delay_coordinated", PED_COLS, _PED.format(log=_DAY100))
def _(v):
    return M.ped_delay(_scaled_cycles(v.stored_day()), max_free=30000)


@query("m19_ped_delay_free", PED_COLS, _PED.format(log="(SELECT * FROM event_log_day WHERE EventCode <> 132)"))
def _(v):
    return M.ped_delay(v.stored_day().where("EventCode <> 132"), max_free=30000)


# Levels and terminations ----------------------------------------------------------------------


@query(
    "m20_detection_levels", "SignalID, Level:int",
    """SELECT s.SignalID, coalesce(l.Level, 0) AS Level FROM (SELECT DISTINCT cast(o_custkey % 60 as varchar) AS SignalID FROM orders) s LEFT JOIN (
    SELECT SignalID, CASE WHEN bool_or(lv IS NULL) THEN NULL ELSE max(lv) END AS Level FROM (SELECT *, CASE
    WHEN kinds LIKE '%Advanced Count%' AND main THEN 1 WHEN kinds LIKE '%Stop Bar Presence%' AND NOT main THEN 1
    WHEN kinds LIKE '%Stop Bar Presence%' THEN 2 WHEN kinds LIKE '%Lane-by-lane Count%' THEN 3 END AS lv FROM (
      SELECT cast(p_partkey % 50 as varchar) AS SignalID, p_size % 8 + 1 IN (2, 6) AS main,
      CASE p_partkey % 50 % 3 WHEN 0 THEN 'Lane-by-lane Count, Stop Bar Presence' WHEN 1 THEN CASE WHEN p_size % 2 = 0 THEN 'Stop Bar Presence'
      ELSE 'Lane-by-lane Count' END ELSE 'Advanced Count' END AS kinds FROM part)) GROUP BY ALL) l USING (SignalID)""",
)
def _(v):
    k = F.col("p_partkey") % 50
    kinds = (
        F.when(k % 3 == 0, "Lane-by-lane Count, Stop Bar Presence")
        .when(k % 3 == 1, F.when(F.col("p_size") % 2 == 0, "Stop Bar Presence").otherwise("Lane-by-lane Count"))
        .otherwise("Advanced Count")
    )
    config = v.table("part").select(k.cast("string").alias("SignalID"), (F.col("p_size") % 8 + 1).alias("CallPhase"), kinds.alias("DetectionTypeDesc"))
    signals = v.table("orders").select((F.col("o_custkey") % 60).cast("string").alias("SignalID"))
    return M.detection_levels(config, signals)


@query(
    "m21_terminations", "SignalID, CallPhase:int, Date, Cycles:bigint, ~GapOut, ~MaxOut, ~ForceOff",
    """SELECT SignalID, Phase AS CallPhase, Date, count(*) AS Cycles, count(*) FILTER (WHERE TermType = 4) / count(*) AS GapOut,
    count(*) FILTER (WHERE TermType = 5) / count(*) AS MaxOut, count(*) FILTER (WHERE TermType = 6) / count(*) AS ForceOff FROM cycles
    WHERE EventCode = 1 AND TermType <> 0 GROUP BY ALL""",
)
def _(v):
    return M.terminations(v.stored_tables()[1])


# Delay and transition -------------------------------------------------------------------------


def delay_sql(fl, minutes: int) -> str:
    return f"""WITH w AS (SELECT d.SignalID, d.Date, d.Phase, d.DetTimeStamp, d.CycleStart, CASE WHEN d.EventCode = 1 THEN 0
        ELSE {secs('d.DetTimeStamp', 'g.PhaseStart')} END AS delay FROM detections d ASOF LEFT JOIN
        (SELECT DISTINCT SignalID, Date, Phase, PhaseStart FROM cycles WHERE EventCode = 1) g
        ON d.SignalID = g.SignalID AND d.Date = g.Date AND d.Phase = g.Phase AND d.DetTimeStamp <= g.PhaseStart),
      l AS (SELECT SignalID, Date, Timestamp, nullif(EventParam, 0) AS cl FROM {_DAY100} WHERE EventCode = 132),
      t AS (SELECT w.*, coalesce(l.cl, m.mx, 180) AS cl FROM w ASOF LEFT JOIN (SELECT SignalID, Date, Timestamp, max(cl) AS cl FROM l GROUP BY ALL) l
        ON w.SignalID = l.SignalID AND w.Date = l.Date AND w.CycleStart >= l.Timestamp
        LEFT JOIN (SELECT SignalID, Date, max(cl) AS mx FROM l GROUP BY ALL) m ON m.SignalID = w.SignalID AND m.Date = w.Date),
      f AS (SELECT SignalID, Hour, sum(mn * n) / sum(n) AS delay, sum(n) AS vol FROM (SELECT SignalID, Phase, {fl('DetTimeStamp')} AS Hour, avg(delay) AS mn,
        count(*) AS n FROM t WHERE delay < cl * 3 GROUP BY ALL) GROUP BY ALL)
      SELECT SignalID, Hour, coalesce(delay, 0) AS delay, coalesce(vol, 0) AS vol FROM (SELECT SignalID, unnest(generate_series(cast(Date as timestamp),
        cast(Date as timestamp) + interval 1 day - interval {minutes} minute, interval {minutes} minute)) AS Hour
        FROM (SELECT DISTINCT SignalID, Date FROM detections)) LEFT JOIN f USING (SignalID, Hour)"""


@query("m24_approach_delay", "SignalID, Hour, ~delay, vol:bigint", delay_sql(hour, 60))
def _(v):
    log, cycles, detections = v.stored_tables()
    return M.approach_delay(detections, cycles, _scaled_cycles(log))


@query("m26_approach_delay_15min", "SignalID, Hour, ~delay, vol:bigint", delay_sql(quarter_hour, 15))
def _(v):
    log, cycles, detections = v.stored_tables()
    return M.approach_delay(detections, cycles, _scaled_cycles(log), minutes=15)


TINT_SQL = f"""WITH c AS (SELECT SignalID, Date, Timestamp, EventParam AS p, lag(EventParam) OVER w AS prev,
    last_value(CASE WHEN EventParam = 5 THEN Timestamp END IGNORE NULLS) OVER (PARTITION BY SignalID, Date ORDER BY Timestamp
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS five FROM event_log_day WHERE EventCode = 150
    WINDOW w AS (PARTITION BY SignalID, Date ORDER BY Timestamp, EventParam)),
  e AS (SELECT SignalID, Date, Timestamp AS e, {secs('five', 'Timestamp')} AS cl FROM c WHERE p = 5 AND prev = 1),
  t AS (SELECT SignalID, Date, {secs('min(s)', 'e')} AS sec, any_value(cl) AS cl FROM (SELECT c.SignalID, c.Date, c.Timestamp AS s, e.e, e.cl FROM
    (SELECT * FROM c WHERE p IN (2, 3, 4)) c ASOF JOIN e ON c.SignalID = e.SignalID AND c.Date = e.Date AND c.Timestamp <= e.e) GROUP BY SignalID, Date, e),
  x AS (SELECT SignalID, Date, sec / 60 AS t, coalesce(ceil(sec / cl), 1) AS n FROM t)
  SELECT SignalID, Date, min(t) AS TimeInTransition_min, median(t) AS TimeInTransition_median, max(t) AS TimeInTransition_max, count(*) AS Transitions,
  sum(t) AS tint, min(n) AS CyclesInTransition_min, median(n) AS CyclesInTransition_median, max(n) AS CyclesInTransition_max,
  sum(n) AS CyclesInTransition_sum FROM x GROUP BY ALL"""


@query(
    "m27_time_in_transition",
    "SignalID, Date, ~TimeInTransition_min, ~TimeInTransition_median, ~TimeInTransition_max, Transitions:bigint, ~tint, ~CyclesInTransition_min, "
    "~CyclesInTransition_median, ~CyclesInTransition_max, ~CyclesInTransition_sum",
    TINT_SQL,
)
def _(v):
    return M.time_in_transition(v.stored_day())


@query(
    "m29_event_measures", "name, SignalID, rows:bigint, ~total",
    f"""SELECT 'arrivals_on_green' AS name, SignalID, count(*) AS rows, sum(All_Arrivals) AS total FROM ({aog_sql(60)}) GROUP BY ALL UNION ALL
    SELECT 'phase_termination', SignalID, count(*), sum(n) FROM (SELECT SignalID, Phase, count(*) AS n FROM cycles WHERE EventCode = 1 AND TermType <> 0
      GROUP BY ALL) GROUP BY ALL UNION ALL
    SELECT 'time_in_transition', SignalID, count(*), sum(tint) FROM ({TINT_SQL}) GROUP BY ALL""",
)
def _(v):
    log, cycles, detections = v.stored_tables()
    tables = event_measures(log, cycles, detections, v.det_config())
    value = {"arrivals_on_green": "vol", "phase_termination": "Cycles", "time_in_transition": "tint"}
    parts = [
        tables[t].groupBy("SignalID").agg(F.count("*").alias("rows"), F.sum(c).alias("total")).withColumn("name", F.lit(t)) for t, c in value.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


