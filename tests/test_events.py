"""Pairing and attribution, one case per trap."""

from pyspark.sql import functions as F

from phasewright.operators import events as E
from phasewright.operators import wide as W
from tests.conftest import DAY, at, rows


def test_first_end_of_a_start_and_latest_start_of_an_end(log):
    p = E.green_time(log(("1", "8:00", 1, 2), ("1", "8:00:30", 1, 2), ("1", "8:00:40", 8, 2), ("1", "8:00:50", 8, 2), ("1", "9:10", 8, 2)))
    assert rows(p, "StartTimeStamp", "EndTimeStamp", "Duration") == [(at("8:00:30"), at("8:00:40"), 10.0)]


def test_pairs_across_bins_and_keys(log):
    p = E.green_time(log(("1", "8:59:50", 1, 2), ("1", "9:00:10", 8, 2), ("1", "8:59:55", 1, 4), ("2", "9:00:05", 8, 2)))
    assert rows(p, "SignalID", "EventParam", "Duration") == [("1", 2, 20.0)]


def test_tied_ends_vanish(log):
    # Two off events of one detector at one instant can only come from different codes.
    events = log(("1", "8:00", 1, 2), ("1", "8:00:10", 8, 2), ("1", "8:00:10", 8, 2), ("1", "8:00:20", 8, 2))
    assert rows(E.green_time(events)) == []


def test_exact_match_and_strict(log):
    greens = log(("1", "8:00", 1, 2), ("1", "8:01", 1, 2), ("1", "8:03", 1, 2))
    assert rows(E.phase_cycle(greens), "Duration") == [(0.0,), (0.0,), (0.0,)]
    assert rows(E.phase_cycle(greens, strict=True), "StartTimeStamp", "Duration") == [(at("8:00"), 60.0), (at("8:01"), 120.0)]


def test_pairs_by_param_field(log):
    events = log(("1", "8:00", 150, 2), ("1", "8:05", 150, 5), ("1", "8:06", 150, 3), ("1", "8:07", 150, 5))
    p = E.pairs(events, [2, 3], [5], "EventParam")
    assert rows(p, "StartTimeStamp", "EventParam", "Duration") == [(at("8:00"), 2, 300.0), (at("8:06"), 3, 60.0)]


def test_colour_intervals_equal_the_three_pairings(log):
    events = log(*[("1", f"8:{m:02d}:{s:02d}", c, 2) for m, s, c in [(0, 0, 1), (0, 30, 8), (0, 34, 9), (1, 10, 1), (1, 10, 8), (1, 40, 8), (1, 44, 9), (2, 0, 1)]])
    one = E.colour_intervals(events)
    three = E.green_time(events).unionByName(E.yellow_time(events)).unionByName(E.red_time(events))
    cols = ["EventCode", "StartTimeStamp", "EndTimeStamp", "Duration"]
    assert rows(one, *cols) == rows(three, *cols) != []


def test_barriers(log):
    events = log(("1", "8:00", 0, 2), ("1", "8:00", 12, 4), ("1", "8:05", 0, 3), ("1", "8:05", 12, 1), ("1", "8:06", 0, 2), ("1", "8:06", 12, 6))
    added = E.add_barriers(events).where("EventCode = 31")
    assert rows(added, "Timestamp", "EventParam") == [(at("8:00"), 1), (at("8:05"), 2)]


def _config(spark):
    return E.count_detector_flag(spark.createDataFrame(
        [("1", 5, 2, 1, 10.0), ("1", 6, 2, 2, None), ("2", 5, 2, 1, 0.0)],
        "SignalID string, Detector int, CallPhase int, CountPriority int, TimeFromStopBar double",
    ))


def _cycle(signal, day=DAY, term=True):
    out = [
        (signal, "7:59:50", 31, 1, day), (signal, "8:00", 1, 2, day), (signal, "8:00:30", 8, 2, day), (signal, "8:00:34", 9, 2, day),
        (signal, "8:01:30", 1, 2, day), (signal, "8:00:15", 82, 5, day), (signal, "8:00:16", 81, 5, day),
        (signal, "8:00:28", 82, 6, day), (signal, "8:00:29.5", 81, 6, day),
    ]
    return out + ([(signal, "8:00:30", 4, 2, day)] if term else [])


def test_etl_attributes_detections_and_terminations(spark, log):
    cycles, detections = E.etl(log(*_cycle("1"), *_cycle("2", term=False)), _config(spark))
    assert rows(cycles, "SignalID", "EventCode", "PhaseStart", "TermType", "Volume", "CycleStart") == [
        ("1", 1, at("8:00"), 4, 1, at("7:59:50")), ("1", 8, at("8:00:30"), 0, 0, at("7:59:50")), ("1", 9, at("8:00:34"), 0, 0, at("7:59:50")),
    ]
    # Detector 5 is moved 10 s to the stop bar; signal 2 has no termination and is left out.
    assert rows(detections, "Detector", "DetTimeStamp", "DetDuration", "EventCode", "DetTimeInPhase", "DetTimeInCycle") == [
        (5, at("8:00:25"), 1.0, 1, 25.0, 35.0), (6, at("8:00:28"), 1.5, 1, 28.0, 38.0),
    ]


def test_many_days_equal_the_union_of_single_days(spark, log):
    nxt = DAY.replace(day=3)
    both = E.etl(log(*_cycle("1"), *_cycle("1", nxt)), _config(spark))
    single = [E.etl(log(*_cycle("1", d)), _config(spark)) for d in (DAY, nxt)]
    for i in range(2):
        assert rows(both[i]) == sorted(rows(single[0][i]) + rows(single[1][i]), key=str) or sorted(map(str, rows(both[i]))) == sorted(
            map(str, rows(single[0][i]) + rows(single[1][i]))
        )


def test_count_detector_is_the_least_priority_of_its_phase(spark):
    assert rows(_config(spark), "SignalID", "Detector", "CountDetector") == [("1", 5, True), ("1", 6, False), ("2", 5, True)]


def test_copy_down_spreads_over_the_instant(log):
    events = log(("1", "8:00", 1, 2), ("1", "8:00", 31, 7), ("1", "9:30", 1, 4), ("2", "9:30", 1, 4))
    out = W.copy_updown(events, [31], "Ring", [], "EventParam")
    assert rows(out, "SignalID", "Timestamp", "EventCode", "Ring") == [
        ("1", at("8:00"), 1, 7), ("1", at("8:00"), 31, 7), ("1", at("9:30"), 1, 7), ("2", at("9:30"), 1, None),
    ]


def test_off_code_ends_a_state(log):
    events = log(("1", "8:00", 183, 9), ("1", "8:10", 1, 2), ("1", "9:30", 182, 1), ("1", "9:40", 1, 2))
    out = W.copy_updown(events, [183, 184], "PowerFailure", [], "EventParam", off=182)
    assert rows(out, "Timestamp", "PowerFailure") == [(at("8:00"), 9), (at("8:10"), 9), (at("9:30"), None), (at("9:40"), None)]


def test_widen_knows_the_state_of_the_day_before(spark, log):
    before = DAY.replace(day=1)
    events = log(("1", "22:00", 131, 3, before), ("1", "8:00", 0, 2), ("1", "8:00:01", 1, 2), ("1", "8:00:05", 82, 5), ("1", "8:00:06", 81, 5), ("1", "8:00:20", 8, 2))
    config = spark.createDataFrame([("1", 5, 2, 2.0, DAY)], "SignalID string, Detector int, CallPhase int, TimeFromStopBar double, Date date")
    wide = W.widen(events, config).where(F.col("Date") == F.lit(DAY))
    got = rows(wide.where("EventCode = 82"), "Timestamp", "CoordPattern", "Phase", "Interval", "PhaseStart", "DetectorOff", "DetectorDuration")
    assert got == [(at("8:00:07"), 3, 2, 1, at("8:00"), at("8:00:08"), 1.0)]
    assert wide.where("EventCode = 81").count() == 0


def test_channel_phase_mapping_needs_one_match(log):
    events = log(("1", "8:00", 82, 5), ("1", "8:00:00.1", 43, 2), ("1", "8:01", 82, 5), ("1", "8:01", 82, 6), ("1", "8:01:00.1", 43, 4))
    assert rows(E.channel_phase_mapping(events)) == [("1", 5, 2)]
