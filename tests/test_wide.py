"""Wide events: states across bins and days, and what the plan moves."""

from datetime import date

import pytest
from conftest import DAY, at, rows
from pyspark.sql import functions as F

from phasewright.operators import wide as W

YESTERDAY, TOMORROW, OLD = date(2024, 1, 1), date(2024, 1, 3), date(2023, 12, 31)


@pytest.fixture(scope="module")
def config(spark):
    rows = [("1", d, 2 * d, 1.5 * d, day) for d in (1, 2) for day in (YESTERDAY, DAY, TOMORROW)]
    return spark.createDataFrame(rows, "SignalID string, Detector int, CallPhase int, TimeFromStopBar double, Date date")


def test_states_last_into_the_next_day_only(log, config):
    events = log(("1", "8:00", 131, 7, OLD), ("1", "9:00", 131, 5, YESTERDAY), ("1", "10:00", 1, 2, DAY), ("1", "10:00", 1, 2, TOMORROW), ("1", "7:00", 173, 1, YESTERDAY))
    seen = lambda **kw: {r["Date"]: r["CoordPattern"] for r in W.widen(events, config, **kw).where("EventCode = 1").collect()}
    assert seen() == {DAY: 5, TOMORROW: None}
    assert seen(days_before=None) == {DAY: 5, TOMORROW: 5}
    assert seen(days_before=0) == {DAY: None, TOMORROW: None}
    first = W.widen(events, config).where("EventCode = 173").collect()
    assert [r["CoordPattern"] for r in first] == [7]


def test_an_end_is_carried_over_bins(log, config):
    events = log(("1", "1:00", 183, 3), ("1", "2:00", 1, 2), ("1", "3:00", 182, 0), ("1", "9:00", 1, 4), ("1", "0:10", 84, 1), ("1", "5:00", 82, 1), ("1", "5:30", 83, 1), ("1", "12:00", 82, 1))
    for seconds in (60, 3600, 86_400):
        wide = W.widen(events, config, bin_seconds=seconds)
        assert rows(wide.where("EventCode = 1"), "Phase", "PowerFailure") == [(2, 3), (4, None)]
        assert [f for _, f in rows(wide.where("EventCode = 82"), "Timestamp", "DetectorFault")] == [1, None]


def test_an_off_shifted_past_midnight_ends_its_on(log, config):
    events = log(("1", "23:59:50", 82, 2), ("1", "23:59:58", 81, 2), ("1", "0:00:10", 82, 2, TOMORROW), ("1", "0:01", 81, 2, TOMORROW), ("1", "23:00", 82, 1), ("1", "1:00", 81, 1, TOMORROW))
    got = rows(W.widen(events, config), "Date", "Detector", "DetectorDuration")
    assert got == [(DAY, 1, None), (DAY, 2, 8.0), (TOMORROW, 2, 50.0)]


def test_a_day_with_shifted_events_alone_is_not_produced(log, config):
    events = log(("1", "23:59:59", 82, 2), ("1", "12:00", 1, 2), ("2", "12:00", 1, 2, TOMORROW))
    assert rows(W.widen(events, config), "Date", "SignalID", "EventCode") == [(DAY, "1", 1), (TOMORROW, "2", 1)]


def test_windows_share_one_exchange_of_the_rows(log, config):
    events = log(("1", "8:00", 82, 1), ("1", "9:00", 0, 2))
    keys = {name: F.col("EventParam") + n for n, name in enumerate(("Detector", "Phase", "PedInput"))}
    placed = events.withColumns({"_own": F.col("Date"), "_bin": F.hour("Timestamp"), **keys})
    filled = W._fill_bins(placed, W.wide_states())
    filled.collect()
    plan = filled._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning(") == 1 and plan.count("Window") > 5


def test_rows_without_a_key_and_many_states_at_once(log, config):
    events = log(("1", "8:00", 0, 2), ("1", "8:00", 1, 4), ("1", "8:00", 502, 1), ("1", "8:00:01", 8, 2), ("1", "8:00:01", 300, 9), ("1", "8:00:01", 612, 4))
    got = {(r["EventCode"], r["EventParam"]): r for r in W.widen(events, config).collect()}
    start = at("8:00")
    assert got[1, 4]["PhaseStart"] == start and got[502, 1]["PhaseStart"] is None  # an instant's start is known to all phases there
    assert got[8, 2]["RecordedSplit"] is None and got[300, 9]["Phase"] == 1 and got[300, 9]["RecordedSplit"] == 9
    assert got[8, 2]["PedWait"] == 4 and got[612, 4]["PedWait"] == 4


def test_dense_hours_are_cut_and_dealt_by_rows(log, config, monkeypatch):
    code = lambda n: (82, 81, 1, 8, 0, 31, 84, 83)[n % 8]
    events = log(*[("1", f"8:{n // 60}:{n % 60}", code(n), n % 2 + 1) for n in range(1200)], ("1", "7:00", 131, 4), ("1", "9:30", 1, 2))
    want, staged, stage = rows(W.widen(events, config)), {}, W.stage
    monkeypatch.setattr(W, "stage", lambda df, name: staged.setdefault(name, stage(df, name)))
    monkeypatch.setattr(W, "BIN_ROWS", 40, raising=False)
    monkeypatch.setattr(W, "TASK_ROWS", 100, raising=False)
    assert rows(W.widen(events, config)) == want
    filled = staged["filled-bins"]
    assert filled.groupBy("_bin").count().agg(F.max("count")).first()[0] <= 40
    assert filled.select(F.input_file_name()).distinct().count() > 6  # bins of one hour lie in many tasks


def test_bins_are_a_second_at_the_least(log, monkeypatch):
    monkeypatch.setattr(W, "BIN_ROWS", 3)
    burst = log(*[("1", "8:00:01", 82, n) for n in range(30)], ("1", "8:00:02", 82, 1))
    assert W._dealing(burst, 3600)[0] == 1 and W._dealing(burst.limit(3), 3600)[0] == 3600 and W._dealing(burst.limit(0), 60)[0] == 60


@pytest.mark.parametrize("measure", [W.arrivals_by_interval, W.wide_counts])
def test_measures_of_dense_hours_hold_few_rows_in_a_task(log, config, monkeypatch, measure):
    cycle = ((0, 2), (1, 2), (82, 1), (81, 1), (8, 2), (82, 1), (81, 1), (10, 2), (82, 1), (81, 1))
    events = log(*[("1", f"8:{n // 20}:{n % 20}", *cycle[n % 10]) for n in range(400)])
    want, staged, stage = rows(measure(W.widen(events, config))), {}, W.stage
    monkeypatch.setattr(W, "stage", lambda df, name: staged.setdefault(name, stage(df, name)))
    monkeypatch.setattr(W, "BIN_ROWS", 20, raising=False)
    monkeypatch.setattr(W, "TASK_ROWS", 40, raising=False)
    assert want and rows(measure(W.widen(events, config))) == want
    per_task = staged["filled-bins"].groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert per_task <= 200
