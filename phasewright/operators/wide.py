"""Wide events: controller state carried onto each event (E09-E11) and measures over them."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasewright.functions.calendar import floor_minutes, micros, midnight, plus_seconds, seconds_between
from phasewright.operators.carry import Mark, carry
from phasewright.session import stage

# Event codes of the controller log.
DETECTOR_CODES = range(81, 89)
FAULT_CODES, FAULT_END = range(84, 89), 83
PROGRAMMED_SPLIT = range(134, 150)
RECORDED_SPLIT = range(300, 316)
PED_WAIT = range(612, 652)
PHASE_CODES = [*range(0, 25), *range(41, 50), 151]
INTERVAL_CODES = {1: "Green", 8: "Yellow", 10: "Red"}
PHASE_CALL_CODES = (43, 44)
POWER_CODES, POWER_RESTORED = (183, 184), 182
BARRIER, COORD_PATTERN, CYCLE_LENGTH, CYCLE_OFFSET = 31, 131, 132, 133
ACTUAL_CYCLE_LENGTH, ACTUAL_NATURAL_CYCLE_LENGTH, ACTUAL_CYCLE_OFFSET = 316, 317, 318
COORD_STATE, FLASH_STATUS = 150, 173
PHASE_ON, TERMINATIONS = 0, (4, 5, 6)
DETECTOR_OFF, DETECTOR_ON, PED_OFF, PED_ON = 81, 82, 89, 90


def derive_on_codes(df: DataFrame, codes, source, name: str, fn=lambda c: c) -> DataFrame:
    """Set a column on the given event codes only (E09); other rows keep their value."""
    col = F.col(source) if isinstance(source, str) else source
    kept = F.col(name) if name in df.columns else F.lit(None)
    return df.withColumn(name, F.when(F.col("EventCode").isin(*codes), fn(col)).otherwise(kept))


@dataclass(frozen=True)
class State:
    """A state that starts at events of ``codes`` and lasts until the next one (or ``off``).

    ``spread`` gives the value to all rows of the signal at that instant ("all"), to
    those of the group ("group"), or to the event's row alone (None).
    """

    name: str
    codes: tuple[int, ...]
    value: Column
    off: int | None = None
    spread: str | None = "all"
    when: Column | None = None


def stamp_states(df: DataFrame, group: list[str], states: list[State]) -> DataFrame:
    """Put the value each state takes at its own events into ``_s_<name>`` (wrapped, so off is a value too)."""
    instant = ["SignalID", "Date", "Timestamp"]
    cols = []
    for s in states:
        hit = F.col("EventCode").isin(*s.codes)
        if s.when is not None:
            hit = hit & s.when
        value = F.when(hit, s.value)
        if s.spread == "all":
            value = F.max(value).over(Window.partitionBy(*instant))
        elif s.spread == "group":
            value = F.max(value).over(Window.partitionBy(*dict.fromkeys([*instant, *group])))
        stamped = F.when(value.isNotNull(), F.struct(value.alias("v")))
        if s.off is not None:
            nothing = F.struct(F.when(F.lit(False), s.value).alias("v"))
            stamped = F.when(F.col("EventCode") == s.off, nothing).otherwise(stamped)
        for g in group:
            stamped = F.when(F.col(g).isNotNull(), stamped)
        cols.append(stamped.alias(f"_s_{s.name}"))
    return df.select("*", *cols)


def carry_states(
    df: DataFrame,
    group: list[str],
    names: list[str],
    *,
    up: bool = False,
    source: DataFrame | None = None,
    days_before: int = 0,
    bin_seconds: int = 3600,
) -> DataFrame:
    """Carry stamped states down to later events of the group, or up to earlier ones."""
    sign = -1 if up else 1
    out = carry(
        df, [*dict.fromkeys(["SignalID", "Date", *group])], "Timestamp",
        [Mark(f"_c_{n}", F.col(f"_s_{n}").isNotNull(), F.col(f"_s_{n}")) for n in names],
        rank=F.struct((sign * F.col("EventCode")).alias("c"), (sign * F.col("EventParam")).alias("p")),
        forward=up, source=source, days_before=days_before, bin_seconds=bin_seconds,
    )
    kept = [c for c in out.columns if not c.startswith("_c_")]
    return out.select(*kept, *[F.col(f"_c_{n}.v").alias(n) for n in names])


def copy_updown(
    df: DataFrame, codes, name: str, group: list[str], value, *,
    off: int | None = None, up: bool = False, spread: str | None = "all", bin_seconds: int = 3600,
) -> DataFrame:
    """Carry one value from marker events over their group."""
    state = State(name, tuple(codes), F.col(value) if isinstance(value, str) else value, off, spread)
    stamped = stamp_states(df, group, [state])
    out = carry_states(stamped, group, [name], up=up, bin_seconds=bin_seconds)
    return out.drop(f"_s_{name}")


@dataclass(frozen=True)
class Carried:
    """States that share a key beside the signal: carried down to later rows, and up to earlier ones of the same day."""

    group: str | None
    down: tuple[State, ...] = ()
    up: tuple[State, ...] = ()


def wide_states() -> list[Carried]:
    """The states of a wide row by the key they belong to."""
    at, code, param = F.col("Timestamp"), F.col("EventCode"), F.col("EventParam")
    by_signal = (
        State("Ring", (BARRIER,), param), State("CycleStart", (BARRIER,), at, when=param == 1),
        State("CoordPattern", (COORD_PATTERN,), param), State("CycleLength", (CYCLE_LENGTH,), param),
        State("CycleOffset", (CYCLE_OFFSET,), param), State("ActualCycleLength", (ACTUAL_CYCLE_LENGTH,), param),
        State("ActualNaturalCycleLength", (ACTUAL_NATURAL_CYCLE_LENGTH,), param), State("ActualCycleOffset", (ACTUAL_CYCLE_OFFSET,), param),
        State("CoordState", (COORD_STATE,), param), State("FlashStatus", (FLASH_STATUS,), param),
        State("PowerFailure", POWER_CODES, param, off=POWER_RESTORED),
    )
    by_phase = (
        State("PhaseStart", (PHASE_ON,), at), State("Interval", tuple(INTERVAL_CODES), code, spread="group"),
        State("ProgrammedSplit", tuple(PROGRAMMED_SPLIT), param, spread="group"), State("PedWait", tuple(PED_WAIT), param),
    )
    return [
        Carried(None, by_signal),
        Carried("Phase", by_phase, (State("RecordedSplit", tuple(RECORDED_SPLIT), param, spread="group"),)),
        Carried("Detector", (State("DetectorFault", tuple(FAULT_CODES), param, off=FAULT_END),), (State("DetectorOff", (DETECTOR_OFF,), at, spread=None),)),
        Carried("PedInput", (), (State("PedInputOff", (PED_OFF,), at, spread=None),)),
    ]


_PLACE = ["SignalID", "Date", "_bin"]
# About as many rows as one bin and one task hold; bins get narrower and tasks more as the events of a day get denser.
BIN_ROWS, TASK_ROWS = 10_000, 60_000


def _bin_at(seconds: int) -> Column:
    return F.floor((micros("Timestamp") - micros(midnight("Date"))) / (seconds * 1_000_000)).cast("int")


def _dealing(rows: DataFrame, widest: int) -> tuple[int, int]:
    """Seconds of a bin, so that the fullest holds at most ``BIN_ROWS`` (one second at the least), and the number of tasks.

    Two numbers are read for each width tried, mostly one or two widths.
    """
    width, placed = widest, rows.where("SignalID is not null and Timestamp is not null")
    while True:
        bins = placed.groupBy("SignalID", "Date", _bin_at(width).alias("_bin")).count()
        fullest, total = (n or 0 for n in bins.agg(F.max("count"), F.sum("count")).first())
        if fullest <= BIN_ROWS or width <= 1:
            return width, max(ceil(total / TASK_ROWS), rows.sparkSession.sparkContext.defaultParallelism)
        width = max(1, int(width // ceil(fullest / BIN_ROWS)))


def _shifted() -> Column:
    """Rows that their detector's distance has put into the day after their own."""
    return F.col("_own") < F.col("Date")


def _stamp(state: State, group: str | None) -> Column:
    """What a state takes at its own events; null elsewhere. Of a state with an end it is a struct, so that the end is a value too."""
    hit = F.col("EventCode").isin(*state.codes)
    if state.when is not None:
        hit = hit & state.when
    value = F.when(hit, state.value)
    if state.spread is not None:
        instant = [*_PLACE, "Timestamp", *([group] if group and state.spread == "group" else [])]
        value = F.max(value).over(Window.partitionBy(*instant))
    out = value
    if state.off is not None:
        out = F.when(value.isNotNull(), F.struct(value.alias("v")))
        out = F.when(F.col("EventCode") == state.off, F.struct(F.when(F.lit(False), state.value).alias("v"))).otherwise(out)
    return F.when(F.col(group).isNotNull(), out) if group else out


def _fill_bins(rows: DataFrame, states: list[Carried], tasks: int | None = None) -> DataFrame:
    """Every state inside each bin of a signal. All windows partition by signal, day and bin or finer, so one exchange serves them.

    ``_edge_`` marks the last row of a bin and key (going up: the first), which holds what the bin passes on. The windows of
    a task keep its rows several times over: given ``tasks``, the rows are dealt to as many, whatever the session would merge.
    """
    placed = rows.repartition(*_PLACE) if tasks is None else rows.repartition(tasks, *_PLACE)
    placed = placed.select("*", *[_stamp(s, c.group).alias(f"_s_{s.name}") for c in states for s in (*c.down, *c.up)])
    order = ["Timestamp", "EventCode", "EventParam"]
    for c in states:
        part = Window.partitionBy(*_PLACE, *([c.group] if c.group else []))
        edge = F.lit(False)
        for held, window in ((c.down, part.orderBy(*order)), (c.up, part.orderBy(*[F.desc(o) for o in order]))):
            if held:
                until, name = window.rangeBetween(Window.unboundedPreceding, Window.currentRow), f"_last_{held[0].name}"
                filled = {f"_f_{s.name}": F.last(f"_s_{s.name}", ignorenulls=True).over(until) for s in held}
                placed = placed.withColumns({**filled, name: F.lead(F.lit(1)).over(window).isNull()})
                edge = edge | F.col(name)
        placed = placed.withColumn(f"_edge_{c.group or 'signal'}", edge).drop(*[f"_last_{held[0].name}" for held in (c.down, c.up) if held])
    return placed.drop(*[f"_s_{s.name}" for c in states for s in (*c.down, *c.up)])


def _carry_in(filled: DataFrame, c: Carried, days_before: int | None) -> DataFrame:
    """Per signal, day, bin and key of ``c``: the states that reach the bin from others.

    One row for each bin in which the key has rows: what the bin begins and ends with, and
    from there the nearest states before and after. Only the rows at a bin's edges and those
    shifted past midnight are aggregated. A state lasts into later days until
    ``days_before`` of them have begun (None: for ever). Going up, a marker is found on its own
    day, or just after midnight if its detector's distance has shifted it there.
    """
    group = [c.group] if c.group else []
    order = F.struct("Timestamp", "EventCode", "EventParam")
    late = [s for s in c.up if s.spread is None]
    told = F.col(f"_edge_{c.group or 'signal'}")
    for s in late:
        told = told | (F.col("EventCode").isin(*s.codes) & _shifted())
    told = filled.where(told & F.col(c.group).isNotNull() if c.group else told)
    ends = told.groupBy(*_PLACE, *group).agg(
        *[F.max_by(f"_f_{s.name}", order).alias(f"_e_{s.name}") for s in c.down],
        *[F.min_by(f"_f_{s.name}", order).alias(f"_e_{s.name}") for s in c.up],
        *[F.min(F.when(F.col("EventCode").isin(*s.codes) & _shifted(), s.value)).alias(f"_late_{s.name}") for s in late],
    )
    key = Window.partitionBy("SignalID", *group)
    bins = Window.unboundedPreceding, -1
    earlier = key.orderBy("Date", "_bin").rowsBetween(*bins)
    later = key.orderBy(F.desc("Date"), F.desc("_bin")).rowsBetween(*bins)

    def nearest(name: str, window) -> Column:
        value = F.col(name)
        return F.last(F.when(value.isNotNull(), F.struct(value.alias("s"), F.col("Date").alias("day"))), ignorenulls=True).over(window)

    found = ends.select(
        *_PLACE, *group,
        *[nearest(f"_e_{s.name}", earlier).alias(f"_n_{s.name}") for s in c.down],
        *[nearest(f"_e_{s.name}", later).alias(f"_n_{s.name}") for s in c.up],
        *[nearest(f"_late_{s.name}", later).alias(f"_l_{s.name}") for s in late])

    def on_days(name: str, first: Column, last: Column) -> Column:
        return F.when(F.col(f"{name}.day").between(first, last), F.col(f"{name}.s"))

    today = F.col("Date")
    since = today if days_before is None else F.date_sub(today, days_before)
    down = [(F.col(f"_n_{s.name}.s") if days_before is None else on_days(f"_n_{s.name}", since, today)).alias(s.name) for s in c.down]
    up = []
    for s in c.up:
        own = on_days(f"_n_{s.name}", today, today)
        tomorrow = F.date_add(today, 1)
        up.append((F.coalesce(own, on_days(f"_l_{s.name}", tomorrow, tomorrow)) if s in late else own).alias(s.name))
    return found.select(*_PLACE, *group, F.struct(*down, *up).alias("_in"))


def _carried_states(filled: DataFrame, states: list[Carried], days_before: int | None) -> DataFrame:
    """One row per signal, day and bin: the signal's states, and a map of states for each other key. Days with shifted rows alone have none."""
    out = None
    for c in states:
        part = _carry_in(filled, c, days_before)
        if c.group is None:
            part = part.withColumnRenamed("_in", "_in_signal")
        else:
            held = F.map_from_entries(F.collect_list(F.struct(c.group, "_in")))
            part = part.groupBy(*_PLACE).agg(held.alias(f"_in_{c.group}"))
        out = part if out is None else out.join(part, _PLACE, "left")
    own_days = filled.where(~_shifted()).select("SignalID", "Date").distinct()
    return out.join(own_days, ["SignalID", "Date"], "left_semi")


def widen(events: DataFrame, config: DataFrame, *, bin_seconds: int = 3600, days_before: int | None = 1) -> DataFrame:
    """One wide row per event with the controller state in force.

    Each event is read once. States are filled inside bins of a signal's day, by windows that
    share one exchange; what a bin starts with comes from a table of one small row for each bin,
    in which the last states of earlier bins and days run on, ``days_before`` days at most
    (None: without end). A bin's states of all phases, detectors and inputs sit in one row of
    maps, so rows with and without such a key meet it in one join.

    Bins are ``bin_seconds`` wide, or narrower where a signal's events are dense, and dealt to tasks
    by the number of rows, so what one task holds does not grow with the log. Events of one signal
    and second stay together.

    An event belongs to the day of its shifted time. ``config`` is the detector list by
    date: SignalID, Detector, CallPhase, TimeFromStopBar, Date. A day on which a signal has
    only events shifted over from the day before is not produced.
    """
    code, param = F.col("EventCode"), F.col("EventParam")
    is_det = code.isin(*DETECTOR_CODES)
    rows = events.where(~code.isin(*PHASE_CALL_CODES)).select(
        "SignalID", "Timestamp", "EventCode", "EventParam", F.col("Date").alias("_own"), is_det.alias("_det"))
    dc = config.select(
        "SignalID", F.col("Detector").alias("EventParam"), F.col("CallPhase").alias("_phase"),
        F.coalesce("TimeFromStopBar", F.lit(0.0)).alias("_shift"), F.col("Date").alias("_own"), F.lit(True).alias("_det"),
    )
    rows = rows.join(dc, ["SignalID", "EventParam", "_own", "_det"], "left").drop("_det")
    rows = rows.withColumn("Timestamp", plus_seconds("Timestamp", F.coalesce("_shift", F.lit(0.0)))).drop("_shift")
    rows = stage(rows.withColumn("Date", F.to_date("Timestamp")), "shifted-events")
    width, tasks = _dealing(rows, bin_seconds)
    rows = rows.withColumn("_bin", _bin_at(width))
    rows = rows.withColumn("Detector", F.when(is_det, param)).withColumn("Phase", F.when(is_det, F.col("_phase"))).drop("_phase")
    rows = derive_on_codes(rows, PROGRAMMED_SPLIT, code, "Phase", lambda c: c - (PROGRAMMED_SPLIT[0] - 1))
    rows = derive_on_codes(rows, RECORDED_SPLIT, code, "Phase", lambda c: c - (RECORDED_SPLIT[0] - 1))
    rows = derive_on_codes(rows, PED_WAIT, code, "Phase", lambda c: c - (PED_WAIT[0] - 1))
    rows = derive_on_codes(rows, PHASE_CODES, param, "Phase")
    rows = derive_on_codes(rows, (PED_OFF, PED_ON), param, "PedInput")
    rows = derive_on_codes(rows, TERMINATIONS, code, "TermType")

    states = wide_states()
    filled = stage(_fill_bins(rows, states, tasks), "filled-bins")
    # The small side is hashed, so the wide rows need no sort.
    wide = filled.join(_carried_states(filled, states, days_before).hint("shuffle_hash"), _PLACE)
    for c in states:
        carried = F.col("_in_signal") if c.group is None else F.try_element_at(f"_in_{c.group}", c.group)
        known = [(s, F.coalesce(F.col(f"_f_{s.name}"), carried.getField(s.name))) for s in (*c.down, *c.up)]
        wide = wide.withColumns({s.name: v if s.off is None else v.getField("v") for s, v in known})
    wide = wide.where(~code.isin(DETECTOR_OFF, PED_OFF))
    det_off, ped_off = F.when(code == DETECTOR_ON, F.col("DetectorOff")), F.when(code == PED_ON, F.col("PedInputOff"))
    return wide.select(
        "Timestamp", "SignalID", "EventCode", "EventParam", "Date",
        "Ring", "CycleStart", "CoordPattern", "CoordState", "CycleLength", "ActualCycleLength",
        "ActualNaturalCycleLength", "CycleOffset", "ActualCycleOffset", "FlashStatus", "PowerFailure",
        "Phase", "PhaseStart", "Interval", "TermType", "ProgrammedSplit", "RecordedSplit",
        "Detector", "DetectorFault", det_off.alias("DetectorOff"),
        seconds_between("Timestamp", det_off).alias("DetectorDuration"),
        "PedInput", "PedWait", ped_off.alias("PedInputOff"),
        seconds_between("Timestamp", ped_off).alias("PedInputDuration"),
    )


def arrivals_by_interval(wide: DataFrame, minutes: int = 60) -> DataFrame:
    """Vehicles and their share by interval colour."""
    colour = F.col("Interval").cast("string")
    for c, label in INTERVAL_CODES.items():
        colour = F.when(F.col("Interval") == c, label).otherwise(colour)
    keys = ["SignalID", "Timeperiod", "Phase"]
    n = (
        wide.where("DetectorOff is not null and Phase is not null and Interval is not null")
        .select("SignalID", floor_minutes("Timestamp", minutes).alias("Timeperiod"), "Phase", colour.alias("Interval"))
        .groupBy(*keys, "Interval").agg(F.count("*").alias("Vehicles"))
    )
    return n.withColumn("Percent", F.col("Vehicles") / F.sum("Vehicles").over(Window.partitionBy(*keys)))


def wide_counts(wide: DataFrame, minutes: int = 60) -> DataFrame:
    """Vehicles by signal, period, detector and phase, missing phases kept."""
    return (
        wide.where("DetectorOff is not null")
        .groupBy("SignalID", floor_minutes("Timestamp", minutes).alias("Timeperiod"), "Detector", "Phase")
        .agg(F.count("*").alias("Vehicles"))
    )


def wide_uptime(wide: DataFrame, minutes: int = 1440) -> DataFrame:
    """Share of good polls and mean response time."""
    code, param = F.col("EventCode"), F.col("EventParam")
    good = F.count_if((code == 502) & (param < 100))
    tries = F.count_if((code == 502) & (param >= 0))
    return (
        wide.where(code.isin(502, 503))
        .groupBy("SignalID", floor_minutes("Timestamp", minutes).alias("Timeperiod"))
        .agg(
            F.when(good > 0, F.try_divide(good.cast("double"), tries)).alias("uptime"),
            F.avg(F.when(code == 503, param)).alias("response_ms"),
        )
        .withColumn("CallPhase", F.lit(0))
        .withColumn("DOW", F.date_format("Timeperiod", "EEEE"))
    )
