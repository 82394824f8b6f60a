"""Which rollups each measure gets (P01-P18): dictionaries keyed ``{level}_{period}_{table}``.

Levels are sig, sub and cor; periods dy, wk, mo, qu, with the hourly tables under mo or
wk. A bundle plans a table when it is asked for; publish the tables one by one from a
stored daily measure.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import cache, partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasewright.functions.calendar import is_midweek, is_peak, week
from phasewright.operators import levels as L
from phasewright.operators import measures as M
from phasewright.operators import pedestrian as PB
from phasewright.operators import rollups as A
from phasewright.operators import travel as V
from phasewright.operators.detectors import subcorridor_view
from phasewright.schemas import METRICS, Metric, Target
from phasewright.session import stage

Plan = Callable[[], DataFrame]


class Bundle(Mapping):
    """Tables by name, each planned on first use, and how each is published."""

    def __init__(self, plans: Mapping[str, Plan], targets: Mapping[str, Target]):
        if missing := plans.keys() - targets.keys():
            raise ValueError(f"tables without a target: {sorted(missing)}")
        self.plans = {name: cache(plan) for name, plan in plans.items()}
        self.targets = {name: targets[name] for name in plans}

    def __getitem__(self, name: str) -> DataFrame:
        return self.plans[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self.plans)

    def __len__(self) -> int:
        return len(self.plans)

    def __or__(self, other: Bundle) -> Bundle:
        return Bundle({**self.plans, **other.plans}, {**self.targets, **other.targets})


def _roll(frame: Plan, hierarchy: DataFrame, var: str, wt: str | None, period: str) -> DataFrame:
    if period == "Hour":
        return A.corridor_by_hour(frame(), hierarchy, var, wt)
    rows = A.corridor_rollup(frame(), hierarchy, var, wt, period=period)
    return rows.withColumn("Week", week("Date")) if period == "Date" else rows


def _levels(frames: dict[str, tuple[Plan, str]], corridors: DataFrame, var: str, wt: str | None, table: str) -> Bundle:
    """Signal, corridor and subcorridor tables for each period's signal frame."""
    plans: dict[str, Plan] = {}
    targets: dict[str, Target] = {}
    for per, (plan, period) in frames.items():
        frame = cache(plan)
        cor = cache(partial(_roll, frame, corridors, var, wt, period))
        plans[f"cor_{per}_{table}"] = cor
        plans[f"sub_{per}_{table}"] = partial(_roll, frame, subcorridor_view(corridors), var, wt, period)
        plans[f"sig_{per}_{table}"] = lambda f=frame, c=cor: A.signal_rows(f(), c(), corridors)
        targets |= {f"{level}_{per}_{table}": Target(period, per == "wk", var) for level in ("cor", "sub", "sig")}
    return Bundle(plans, targets)


def _day_week_month(
    df: DataFrame, corridors: DataFrame, var: str, wt: str | None, table: str, *, peak_only: bool = False
) -> Bundle:
    """Weighted means of a measure by day, week and month."""
    return _levels(
        {
            "dy": (partial(A.daily_avg, df, var, wt, peak_only=peak_only), "Date"),
            "wk": (partial(A.weekly_avg, df, var, wt, peak_only=peak_only), "Date"),
            "mo": (partial(A.monthly_avg, df, var, wt or A.ONES, peak_only=peak_only), "Month"),
        },
        corridors, var, wt, table,
    )


def _day_week_month_sums(df: DataFrame, corridors: DataFrame, var: str, table: str, *, midweek: bool = True) -> Bundle:
    """Daily sums, weekly and monthly values of a volume."""
    chosen = df.where(is_midweek("Date")) if midweek else df
    return _levels(
        {
            "dy": (partial(A.daily_sum, df, var), "Date"),
            "wk": (partial(A.weekly_sum, chosen, var), "Date"),
            "mo": (partial(A.monthly_avg, chosen, var), "Month"),
        },
        corridors, var, None, table,
    )


def _by_hour(df: DataFrame, corridors: DataFrame, var: str, wt: str, table: str) -> Bundle:
    """Hourly pattern of a month."""
    return _levels({"mo": (lambda: A.monthly_by_hour(A.avg_by_hour(df, var, wt), var, wt), "Hour")}, corridors, var, wt, table)


def _described(metric: Metric, daily: DataFrame, corridors: DataFrame) -> Bundle:
    """The tables of a measure's descriptor by day, week, month and quarter."""
    targets = {"dy": Target("Date", False, metric.variable), "wk": Target("Date", True, metric.variable), "mo": Target("Month", False, metric.variable), "qu": Target(None)}
    named = {f"{level}_{per}_{metric.table}": target for level in ("sig", "sub", "cor") for per, target in targets.items()}
    return Bundle(A.aggregate_plans(metric, daily, corridors, subcorridor_view(corridors)), named)


def detector_uptime(ddu: DataFrame, corridors: DataFrame) -> Bundle:
    """P01; the daily averages feed six tables and are staged."""
    avg = cache(lambda: stage(A.avg_daily_detector_uptime(ddu)))
    weekly = _levels({"wk": (partial(A.weekly_avg, ddu, "uptime", "all", peak_only=False), "Date")}, corridors, "uptime", "all", "du")
    plans: dict[str, Plan] = {}
    for level, h in (("cor", corridors), ("sub", subcorridor_view(corridors))):
        plans[f"{level}_dy_du"] = lambda h=h: A.corridor_daily_detector_uptime(avg(), h)
        plans[f"{level}_mo_du"] = lambda h=h: A.corridor_monthly_detector_uptime(avg(), h)
    plans["sig_dy_du"] = lambda: A.signal_rows(avg(), plans["cor_dy_du"](), corridors)
    plans["sig_mo_du"] = lambda: A.signal_rows(A.monthly_avg(ddu, "uptime", "all"), plans["cor_mo_du"](), corridors)
    return weekly | Bundle(plans, {name: Target("Date" if "_dy_" in name else "Month", False, "uptime") for name in plans})


def ped_uptime(papd: DataFrame, paph: DataFrame, corridors: DataFrame, calc_start, report_start, report_end, config=None) -> Bundle:
    """Push-button uptime (staged), its rollups, the bad inputs and the repaired counts."""
    pau = stage(PB.ped_uptime(papd, paph, corridors, calc_start, report_start, report_end, config))
    by_input = pau.withColumn("CallPhase", F.col("Detector"))
    frames = {
        "dy": (partial(A.daily_avg, by_input, "uptime"), "Date"),
        "wk": (partial(A.weekly_avg, by_input, "uptime", peak_only=False), "Date"),
        "mo": (partial(A.monthly_avg, by_input, "uptime", "all"), "Month"),
    }
    more = {
        "bad_ped_detectors": lambda: M.bad_ped_inputs(pau),
        "papd_repaired": lambda: M.ped_count_repair(pau, M.bad_ped_inputs(pau)),
    }
    return _levels(frames, corridors, "uptime", None, "pau") | Bundle(more, {name: Target("Date") for name in more})


def ped_activations(papd: DataFrame, paph: DataFrame, corridors: DataFrame) -> Bundle:
    """P03."""
    out = _day_week_month_sums(papd, corridors, "papd", "papd")
    midweek = paph.where(is_midweek("Hour"))
    hours = {
        "wk": (partial(A.weekly_by_hour, midweek, "paph"), "Hour"),
        "mo": (partial(A.monthly_volume_by_hour, paph, "paph"), "Hour"),
    }
    return out | _levels(hours, corridors, "paph", None, "paph")


def ped_delay(daily: DataFrame, corridors: DataFrame) -> Bundle:
    """P04; ``daily`` is the pedestrian delay table."""
    df = daily.select(
        "SignalID", F.lit(0).alias("CallPhase"), "Date", week("Date").alias("Week"),
        F.col("Avg_Max_Ped_Delay").alias("pd"), "Events",
    )
    return _day_week_month(df, corridors, "pd", "Events", "pd")


def comm_uptime(quality: DataFrame, corridors: DataFrame) -> Bundle:
    """P05."""
    return _day_week_month(M.comm_quality_uptime(quality, corridors), corridors, "uptime", None, "cu")


def volumes(vpd: DataFrame, vph: DataFrame, corridors: DataFrame) -> Bundle:
    """Daily and hourly volumes with morning and evening peaks."""
    weekly = cache(lambda: A.weekly_by_hour(vph.where(is_midweek("Hour")), "vph"))
    monthly = cache(partial(A.monthly_volume_by_hour, vph))
    hours = _levels({"wk": (weekly, "Hour"), "mo": (monthly, "Hour")}, corridors, "vph", None, "vph")

    def cor(per: str, period: str, part: str) -> DataFrame:
        peaks = A.corridor_at_peaks(hours[f"cor_{per}_vph"], "vph", period=period)
        return peaks.where(F.col("period_of_day") == part).drop("period_of_day")

    def sig(per: str, frame: Plan, period: str, part: str) -> DataFrame:
        peaks = A.volume_at_peaks(frame(), "vph", period).where(F.col("period_of_day") == part).drop("period_of_day")
        return A.signal_rows(peaks, cor(per, period, part), corridors)

    plans: dict[str, Plan] = {}
    targets: dict[str, Target] = {}
    for per, frame, period in (("wk", weekly, "Date"), ("mo", monthly, "Month")):
        for part, table in (("am", "vphpa"), ("pm", "vphpp")):
            plans[f"cor_{per}_{table}"] = partial(cor, per, period, part)
            plans[f"sig_{per}_{table}"] = partial(sig, per, frame, period, part)
            targets |= {f"{level}_{per}_{table}": Target(period, per == "wk", "vph") for level in ("cor", "sig")}
    return _day_week_month_sums(vpd, corridors, "vpd", "vpd") | hours | Bundle(plans, targets)


def throughput(daily: DataFrame, corridors: DataFrame) -> Bundle:
    """P07."""
    return _day_week_month_sums(daily, corridors, "vph", "tp", midweek=False)


def arrivals_on_green(aog: DataFrame, corridors: DataFrame) -> Bundle:
    """P08."""
    return _day_week_month(aog, corridors, "aog", "vol", "aogd", peak_only=True) | _by_hour(aog, corridors, "aog", "vol", "aogh")


def progression(aog: DataFrame, corridors: DataFrame) -> Bundle:
    """P09."""
    return _day_week_month(aog, corridors, "pr", "vol", "prd", peak_only=True) | _by_hour(aog, corridors, "pr", "vol", "prh")


def split_failures(sf: DataFrame, corridors: DataFrame) -> Bundle:
    """P10: any-phase failures in peak and off-peak hours, and by hour."""
    any_phase = sf.where("CallPhase = 0")
    out = _day_week_month(any_phase.where(is_peak("Date_Hour")), corridors, "sf_freq", "cycles", "sfd")
    out |= _day_week_month(any_phase.where(~is_peak("Date_Hour")), corridors, "sf_freq", "cycles", "sfo")
    return out | _by_hour(any_phase, corridors, "sf_freq", "cycles", "sfh")


def queue_spillback(qs: DataFrame, corridors: DataFrame) -> Bundle:
    """P11."""
    return _day_week_month(qs, corridors, "qs_freq", "cycles", "qsd", peak_only=True) | _by_hour(qs, corridors, "qs_freq", "cycles", "qsh")


def detection_levels(levels: DataFrame, corridors: DataFrame) -> Bundle:
    """P12; ``levels`` has SignalID, Date, Level."""
    df = levels.withColumn("CallPhase", F.lit(0)).withColumn("Week", week("Date"))
    return _day_week_month(df, corridors, "Level", None, "dl")


def terminations(daily: DataFrame, corridors: DataFrame) -> Bundle:
    """Gap-outs, max-outs and force-offs."""
    df = daily.withColumn("Week", week("Date"))
    out = Bundle({}, {})
    for table in ("go", "mo", "fo"):
        out |= _described(METRICS[table], df, corridors)
    return out


def time_in_transition(daily: DataFrame, corridors: DataFrame) -> Bundle:
    """P14."""
    df = daily.withColumn("CallPhase", F.lit(0)).withColumn("Week", week("Date"))
    return _described(METRICS["tint"], df, corridors)


def approach_delay(hourly: DataFrame, corridors: DataFrame) -> Bundle:
    """P15; ``hourly`` is the hourly delay table."""
    daily = A.daily_avg(hourly.withColumn("Date", F.to_date("Hour")), "delay", "vol")
    df = daily.withColumn("CallPhase", F.lit(0)).withColumn("Week", week("Date"))
    return _described(METRICS["ad"], df, corridors)


def complete_span(df: DataFrame, period: str, minutes: int, start, end, fill: dict[str, float] | None = None, by: tuple[str, ...] = ("SignalID",)) -> DataFrame:
    """Every period from ``start`` to before ``end`` for each entity; values are null, or those of ``fill``."""
    first, last = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    grid = df.select(*by).distinct().select(*by, F.explode(F.sequence(first, last - step, step)).alias(period))
    out = grid.join(df, [*by, period], "left")
    return out.na.fill(fill) if fill else out


def complete_days(df: DataFrame, period: str, minutes: int, fill: dict[str, float], by: tuple[str, ...] = ("SignalID", "CallPhase")) -> DataFrame:
    """Every period of the days on which an entity has data, with ``fill`` where a period is missing."""
    day, step = F.col("_day").cast("timestamp_ntz"), F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    last = day + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1440 - minutes))
    grid = df.select(*by, F.to_date(period).alias("_day")).distinct().select(*by, F.explode(F.sequence(day, last, step)).alias(period))
    return grid.join(df, [*by, period], "left").na.fill(fill)


def period_package(df: DataFrame, corridors: DataFrame, var: str, wt: str | None, table: str, *, period: str = "Hour", sums: bool = False) -> Bundle:
    """One measure on hours or quarter-hours at the three levels."""
    signal = cache(partial(A.period_sum, df, var, period) if sums else partial(A.period_avg, df, var, period, wt))
    plans: dict[str, Plan] = {
        f"{level}_{table}": lambda h=h: A.corridor_rollup(signal(), h, var, None, period=period)
        for level, h in (("cor", corridors), ("sub", subcorridor_view(corridors)))
    }
    plans[f"sig_{table}"] = lambda: A.signal_rows(signal(), plans[f"cor_{table}"](), corridors).select(
        "Zone_Group", "Corridor", period, var, "delta"
    )
    return Bundle(plans, {name: Target(period, False, var) for name in plans})


def _hourly_measures(
    paph: DataFrame, bad_ped: DataFrame, vph: DataFrame, aog: DataFrame, sf: DataFrame, qs: DataFrame, delay: DataFrame, *, start, end, period: str = "Hour",
) -> dict[str, tuple[DataFrame, str, str | None, bool]]:
    """The seven measures by hour or quarter-hour: frame, column, weight and whether it is summed.

    Presses of bad input-days are left out. Arrivals and progression have a null row for each
    signal's period without vehicles, so a change after a gap is null. Failures and spillback are
    0 in the missing periods of days with data (quarter-hour failures: of the whole report) and
    averaged without weights.
    """
    quarter = period == "Timeperiod"
    minutes = 15 if quarter else 60
    pa = paph.withColumn("Date", F.to_date(period)).join(bad_ped, ["SignalID", "Detector", "Date"], "left_anti").drop("Date")

    def on_period(df):
        return df.withColumnRenamed("Date_Hour", period) if "Date_Hour" in df.columns else df

    arrivals = complete_span(on_period(aog), period, minutes, start, end)
    failures, spillback = on_period(sf.where("CallPhase = 0")), on_period(qs)
    if quarter:
        failures = complete_span(failures, period, minutes, start, end, {"sf_freq": 0.0}, ("SignalID", "CallPhase"))
    else:
        failures = complete_days(failures, period, minutes, {"sf_freq": 0.0})
    spillback = complete_days(spillback, period, minutes, {"qs_freq": 0.0})
    suffix = "15min" if quarter else "hourly"
    return {
        f"{suffix}_pa": (pa, "paph", None, True), f"{suffix}_vol": (vph, "vph", None, True), f"{suffix}_aog": (arrivals, "aog", "vol", False),
        f"{suffix}_pr": (arrivals, "pr", "vol", False), f"{suffix}_sf": (failures, "sf_freq", None, False),
        f"{suffix}_qs": (spillback, "qs_freq", None, False), f"{suffix}_ad": (delay, "delay", "vol", False),
    }


def hourly_package(*frames: DataFrame, start, end, period: str = "Hour") -> Bundle:
    """The seven measures by hour (P16) or by quarter-hour (P17, ``period="Timeperiod"``) of the report from ``start`` to before ``end``.

    The frames are presses, bad inputs, volumes, arrivals, failures, spillback, delay and the hierarchy.
    """
    *measures, corridors = frames
    out = Bundle({}, {})
    for table, (df, var, wt, sums) in _hourly_measures(*measures, start=start, end=end, period=period).items():
        out |= period_package(df, corridors, var, wt, table, period=period, sums=sums)
    return out


def hourly_levels(*frames: DataFrame, start, end, period: str = "Hour") -> DataFrame:
    """All tables of ``hourly_package`` as one frame (``levels.LONG``), from one dealing of the signals' rows."""
    *measures, corridors = frames
    rows = [
        df.select(
            F.lit(period).alias("per"), F.lit(table).alias("table"), "SignalID", F.col(period).alias("at"), F.col(var).cast("double").alias("value"),
            (F.lit(1.0) if wt is None else F.col(wt).cast("double")).alias("weight"), F.lit(sums).alias("summed"))
        for table, (df, var, wt, sums) in _hourly_measures(*measures, start=start, end=end, period=period).items()
    ]
    signals = stage(L.signal_periods(reduce(DataFrame.unionByName, rows)).withColumn("weight", F.lit(1.0)), "signal-periods")
    return L.level_rows(signals, corridors).select(*L.LONG)


def measure_levels(metric: Metric, daily: DataFrame, corridors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A measure's days, weeks and months on all levels (``levels.LONG``), and its quarters; as the tables of its descriptor.

    ``daily`` should be a stored table.
    """
    var, wt, peak = metric.variable, metric.weight, metric.peak_only
    weekly, monthly = A.weekly_avg(daily, var, wt, peak_only=peak), A.monthly_avg(daily, var, wt or A.ONES, peak_only=peak)
    rows = [
        df.select(
            F.lit(per).alias("per"), F.lit(metric.table).alias("table"), "SignalID", F.col(at).cast("timestamp_ntz").alias("at"), F.col(var).cast("double").alias("value"),
            (F.lit(1.0) if wt is None else F.col(wt).cast("double")).alias("weight"), (F.col("delta") if "delta" in df.columns else F.lit(None).cast("double")).alias("delta"))
        for per, df, at in (("dy", daily, "Date"), ("wk", weekly, "Date"), ("mo", monthly, "Month"))
    ]
    signals = stage(reduce(DataFrame.unionByName, rows), "signal-periods")
    levels = stage(L.level_rows(signals, corridors, named_only=True), "level-rows")
    return levels.select(*L.LONG), L.quarter_rows(levels, wt is None)


def with_quarters(bundle: Bundle, table: str, var: str, wt: str | None = None, operation: str = "avg") -> Bundle:
    """A measure's tables with the quarters of its monthly ones."""
    quarters = {
        f"{level}_qu_{table}": lambda level=level: A.quarterly(bundle[f"{level}_mo_{table}"], var, wt, operation)
        for level in ("sig", "sub", "cor") if f"{level}_mo_{table}" in bundle
    }
    return bundle | Bundle(quarters, {name: Target(None) for name in quarters})


def travel_times(readings: DataFrame, cor_vph: DataFrame, corridors: DataFrame, grouping: list[str], period: str = "monthly", level: str = "cor") -> Bundle:
    """V04 with V05-V07: the four indexes by hour and by month or week; ``readings`` are the segments' with the hierarchy columns."""
    ti = V.travel_time_package(readings, grouping, period)
    if level == "sub":
        ti = subcorridor_view(ti)
    per, by = ("mo", V.index_by_month) if period == "monthly" else ("wk", V.index_by_week)
    plans: dict[str, Plan] = {}
    targets: dict[str, Target] = {}
    for var in ("tti", "pti", "tt", "spd"):
        plans[f"{level}_{per}_{var}h"] = partial(V.index_by_hour, ti, var, cor_vph, corridors)
        plans[f"{level}_{per}_{var}"] = partial(by, ti, var, cor_vph, corridors)
        targets |= {f"{level}_{per}_{var}h": Target("Hour", per == "wk", var), f"{level}_{per}_{var}": Target("Month" if per == "mo" else "Date", per == "wk", var)}
    return Bundle(plans, targets)


def travel_package(readings: DataFrame, cor_vph: DataFrame, sub_vph: DataFrame, corridors: DataFrame) -> Bundle:
    """The travel tables of corridors and subcorridors by month and week (P18): 32 tables. Volumes are those of the level."""
    out = Bundle({}, {})
    for period in ("monthly", "weekly"):
        out |= travel_times(readings, cor_vph, corridors, [*A.CORRIDOR], period)
        out |= travel_times(readings, sub_vph, subcorridor_view(corridors), [*A.CORRIDOR, "Subcorridor"], period, "sub")
    return out


def thin_bindings() -> dict[str, dict]:
    """Weekly, monthly and hourly rollups of each measure as data: operator, column, weight and day filter."""
    volume = {"vpd": ("vpd", True), "papd": ("papd", True), "tp": ("vph", False)}
    ratio = {"aogd": ("aog", "vol"), "prd": ("pr", "vol"), "sfd": ("sf_freq", "cycles"), "qsd": ("qs_freq", "cycles")}
    out = {}
    for table, (var, midweek) in volume.items():
        out[f"weekly_{table}"] = {"operator": A.weekly_sum, "var": var, "wt": None, "midweek": midweek}
        out[f"monthly_{table}"] = {"operator": A.monthly_avg, "var": var, "wt": None, "midweek": midweek}
    for table, (var, wt) in ratio.items():
        out[f"weekly_{table}"] = {"operator": A.weekly_avg, "var": var, "wt": wt, "midweek": False, "peak_only": True}
        out[f"monthly_{table}"] = {"operator": A.monthly_avg, "var": var, "wt": wt, "midweek": False, "peak_only": True}
        out[f"hourly_{table}"] = {"operator": A.avg_by_hour, "var": var, "wt": wt, "midweek": False}
    out["weekly_du"] = {"operator": A.weekly_avg, "var": "uptime", "wt": "all", "midweek": False, "peak_only": False}
    out["monthly_du"] = {"operator": A.monthly_avg, "var": "uptime", "wt": "all", "midweek": False}
    return out


def bind(name: str, df: DataFrame) -> DataFrame:
    """Run one of the thin bindings by name; missing weekly uptimes become 0."""
    b = dict(thin_bindings()[name])
    rows = df.where(is_midweek("Date")) if b.pop("midweek") else df
    operator, var, wt = b.pop("operator"), b.pop("var"), b.pop("wt")
    args = [var] if wt is None else [var, wt]
    out = operator(rows, *args, **b)
    return out.na.fill(0, [var]) if name == "weekly_du" else out

