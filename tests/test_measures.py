"""Measures on hand-made days with the default thresholds."""

import math
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from phasewright.operators import measures as M
from phasewright.operators import pedestrian as PB
from tests.conftest import DAY, at, rows

DET = "SignalID string, Date date, Phase int, Detector int, CycleStart timestamp_ntz, PhaseStart timestamp_ntz, EventCode int, DetTimeStamp timestamp_ntz, DetDuration double"
CYC = "SignalID string, Date date, Phase int, CycleStart timestamp_ntz, PhaseStart timestamp_ntz, PhaseEnd timestamp_ntz, EventCode int, TermType int"


def _det(spark, *data):
    return spark.createDataFrame([("1", DAY, p, d, at(c), at(s), e, at(t), dur) for p, d, c, s, e, t, dur in data], DET)


def _cyc(spark, *data):
    return spark.createDataFrame([("1", DAY, p, at(c), at(s), at(e), code, term) for p, c, s, e, code, term in data], CYC)


def test_uptime_counts_only_gaps_over_fifteen_minutes(log):
    signal, system = M.uptime(log(*[("1", f"{h}:{m:02d}", 1, 2) for h in range(24) for m in range(0, 60, 15) if not (8 <= h < 10)]))
    # The gap runs from 7:45 to 10:00; the last one of the day is just under 15 minutes.
    assert rows(signal, "uptime") == [(pytest.approx(1 - 135 / 1440),)]
    assert rows(system, "uptime_all") == [(pytest.approx(1 - 135 / 1440),)]


def test_comm_uptime_gives_back_system_silence(log):
    out = M.comm_uptime(log(*[("1", f"{h}:{m:02d}", 1, 2) for h in range(24) for m in range(0, 60, 15) if not (8 <= h < 10)]))
    assert rows(out, "uptime") == [(pytest.approx(1.0),)]


def test_split_failure_needs_both_occupancies(spark):
    config = spark.createDataFrame([("1", 4, 7)], "SignalID string, CallPhase int, Detector int")
    cycles = _cyc(
        spark, (4, "8:00", "8:00", "8:00:20", 1, 4), (4, "8:00", "8:00:24", "8:01", 9, 0),
        (4, "8:02", "8:02", "8:02:20", 1, 4), (4, "8:02", "8:02:24", "8:03", 9, 0),
    )
    de = _det(spark, (4, 7, "8:00", "8:00", 1, "8:00:01", 40.0), (4, 7, "8:02", "8:02", 1, "8:02:01", 18.0))
    out = M.split_failures(cycles, de, config)
    assert rows(out, "CallPhase", "sf", "cycles", "sf_freq") == [(0, 1, 2, 0.5), (4, 1, 2, 0.5)]


def test_touching_intervals_have_zero_occupancy_and_absent_ones_too(spark):
    spans = spark.createDataFrame(
        [("1", 4, DAY, at("8:00"), at("8:00"), at("8:00:20")), ("1", 4, DAY, at("8:05"), at("8:05"), at("8:05:20"))],
        "SignalID string, Phase int, Date date, CycleStart timestamp_ntz, IntervalStart timestamp_ntz, IntervalEnd timestamp_ntz",
    )
    de = spark.createDataFrame([("1", 4, DAY, 7, at("8:00:20"), at("8:00:40"))], "SignalID string, Phase int, Date date, Detector int, DetOn timestamp_ntz, DetOff timestamp_ntz")
    assert rows(M.occupancy(de, spans), "CycleStart", "occ") == [(at("8:00"), 0.0), (at("8:05"), 0.0)]


def test_spillback_takes_the_worst_detector(spark):
    config = spark.createDataFrame([("1", 2, 3), ("1", 2, 4)], "SignalID string, CallPhase int, Detector int")
    de = _det(
        spark, (2, 3, "8:00", "8:00", 1, "8:00:01", 1.0), (2, 4, "8:00", "8:00", 1, "8:00:02", 4.0),
        (2, 9, "8:10", "8:10", 1, "8:10:02", 9.0), (2, 3, "8:10", "8:10", 1, "8:10:01", 2.0),
    )
    assert rows(M.queue_spillback(de, config), "qs", "cycles", "qs_freq") == [(1, 2, 0.5)]


def test_ped_delay_free_and_coordinated(log):
    free = [("1", "8:00", 45, 2), ("1", "8:00:20", 21, 2), ("1", "8:10", 45, 2), ("1", "8:20", 21, 2), ("1", "8:30", 45, 4), ("1", "8:30:10", 21, 4)]
    out = M.ped_delay(log(*free))
    assert rows(out, "Pattern", "Avg_Max_Ped_Delay", "Events") == [("Free", 15.0, 2)]
    coord = [("2", "7:00", 132, 100), ("2", "8:00", 22, 2), ("2", "8:00:40", 21, 2), ("2", "8:10", 22, 2), ("2", "8:12", 21, 2)]
    assert rows(M.ped_delay(log(*coord)), "Pattern", "Avg_Max_Ped_Delay", "Events") == [("Coordinated", 40.0, 1)]
    assert rows(M.ped_delay(log(*coord), fill_cycle_length=False)) == []


def test_zero_cycle_length_is_free(log):
    assert rows(M.ped_delay(log(("1", "7:00", 132, 0), ("1", "8:00", 45, 2), ("1", "8:00:20", 21, 2))), "Pattern") == [("Free",)]


def test_approach_delay(spark, log):
    cycles = _cyc(spark, (2, "8:00", "8:00", "8:00:30", 1, 4), (2, "8:01", "8:01:40", "8:02", 1, 4))
    de = _det(
        spark, (2, 3, "8:00", "8:00", 1, "8:00:10", 1.0), (2, 3, "8:00", "8:00:34", 9, "8:01:00", 1.0), (2, 3, "8:00", "8:00:34", 9, "8:01:20", 1.0),
        (2, 3, "8:01", "8:02", 9, "8:30", 1.0),
    )
    out = M.approach_delay(de, cycles, log(("1", "7:00", 132, 100)))
    assert out.count() == 24
    assert rows(out.where("vol > 0"), "Hour", "delay", "vol") == [(at("8:00"), 20.0, 3)]
    # A cycle of 10 s leaves out waits of 30 s or more.
    assert rows(M.approach_delay(de, cycles, log(("1", "7:00", 132, 10))).where("vol > 0"), "delay", "vol") == [(10.0, 2)]
    assert M.approach_delay(de, cycles, log(("1", "7:00", 132, 10)), minutes=15).count() == 96


def test_arrivals_and_green_ratio(spark):
    config = spark.createDataFrame([("1", 3, "Advanced Count")], "SignalID string, Detector int, DetectionTypeDesc string")
    de = _det(spark, (2, 3, "8:00", "8:00", 1, "8:00:10", 1.0), (2, 3, "8:00", "8:00", 1, "8:00:12", 1.0), (2, 3, "8:00", "8:30", 9, "8:40", 1.0))
    out = M.arrivals_on_green(de, config)
    # Half of the hour is green; the red carries into later hours but those have no arrivals.
    assert rows(out, "Hour", "AOG", "gC", "pr") == [(at("8:00"), pytest.approx(2 / 3), 0.5, pytest.approx(4 / 3))]


def test_time_in_transition(log):
    events = log(
        ("1", "7:58", 150, 5), ("1", "8:00", 150, 3), ("1", "8:02", 150, 3), ("1", "8:03", 150, 1), ("1", "8:04", 150, 5), ("1", "8:05", 150, 2), ("1", "8:06", 150, 5),
        ("2", "8:00", 150, 5),
    )
    out = M.time_in_transition(events)
    # From the first start to the 5 that follows a 1: four minutes, in a gap of six between the fives.
    assert rows(out, "SignalID", "Transitions", "tint", "CyclesInTransition_sum") == [("1", 1, 4.0, 1.0)]


def test_detection_level_is_unknown_with_any_unknown_detector(spark):
    config = spark.createDataFrame(
        [("1", 2, "Lane-by-lane Count"), ("1", 4, "Stop Bar Presence"), ("2", 2, "Stop Bar Presence"), ("3", 2, "Lane-by-lane Count"), ("3", 2, "Other")],
        "SignalID string, CallPhase int, DetectionTypeDesc string",
    )
    signals = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "SignalID string")
    assert rows(M.detection_levels(config, signals)) == [("1", 3), ("2", 2), ("3", 0), ("4", 0)]


def test_termination_shares(spark):
    cycles = _cyc(spark, *[(2, f"8:0{i}", f"8:0{i}", f"8:0{i}:30", 1, t) for i, t in enumerate([4, 4, 5, 6, 0])])
    assert rows(M.terminations(cycles), "Cycles", "GapOut", "MaxOut", "ForceOff") == [(4, 0.5, 0.25, 0.25)]


def test_gamma_distribution_at_known_points():
    # Shape 1 is the exponential; shape 1/2 is the error function; shape 2 has a closed form.
    x = np.array([0.1, 1.0, 3.0, 20.0])
    assert PB.regularized_gamma(np.ones(4), x) == pytest.approx(1 - np.exp(-x))
    assert PB.regularized_gamma(np.full(4, 0.5), x) == pytest.approx([math.erf(math.sqrt(v)) for v in x])
    assert PB.regularized_gamma(np.full(4, 2.0), x) == pytest.approx(1 - (1 + x) * np.exp(-x))
    assert np.isnan(PB.regularized_gamma(np.array([0.0]), np.array([1.0])))[0]


def _papd(spark, values, detector=1):
    return spark.createDataFrame([("1", detector, 2, DAY + timedelta(days=i), v) for i, v in enumerate(values)], "SignalID string, Detector int, CallPhase int, Date date, papd int")


def test_low_press_probability(spark):
    both = _papd(spark, [0, 0, 0, 0]).unionByName(_papd(spark, [4, 6, 5, 9], 2)).unionByName(_papd(spark, [3, 3, 3], 3)).unionByName(_papd(spark, [1, 2], 4))
    got = {r["Detector"]: r["p0"] for r in PB.low_press_probability(both, PB.INPUT).collect()}
    m, v = 6.0, 3.5
    want = PB.regularized_gamma(np.array([m * m / v]), np.array([m / v]))[0]
    assert got == {1: 1.0, 2: pytest.approx(want), 3: 1.0}


def test_long_silence_fails_every_day_of_the_run(spark):
    values = [50, 60, 55, 52, 58, 54, 57] * 3 + [0] * 6
    paph = spark.createDataFrame([("1", 1, 2, DAY, at("8:00"), 5)], "SignalID string, Detector int, CallPhase int, Date date, Hour timestamp_ntz, paph int")
    corridors = spark.createDataFrame([("1", DAY)], "SignalID string, Asof date")
    out = PB.ped_uptime(_papd(spark, values), paph, corridors, DAY, DAY, DAY + timedelta(26))
    got = [r["uptime"] for r in out.orderBy("Date").collect()]
    assert got == [1] * 21 + [0] * 6


def test_presses_too_high(spark):
    def hour(d, h, n):
        return ("1", d, d, DAY, at(f"{h}:00"), n)

    paph = spark.createDataFrame(
        [hour(1, 2, 301), hour(2, 1, 61), hour(2, 2, 61), hour(2, 3, 62), hour(3, 1, 61), hour(3, 2, 61), *[hour(4, h, 701) for h in range(6, 10)], hour(5, 8, 6)],
        "SignalID string, Detector int, CallPhase int, Date date, Hour timestamp_ntz, paph int",
    )
    # 1: an hour over 300 at night; 2: third-largest over 60; 4: mean over 600, and far above the others.
    assert rows(PB.presses_too_high(paph, DAY), "Detector") == [(1,), (2,), (4,)]


def test_bad_days_take_the_months_mean(spark):
    bad = spark.createDataFrame([("1", 1, DAY + timedelta(days=2))], "SignalID string, Detector int, Date date")
    out = M.ped_count_repair(_papd(spark, [10, 15, 900]), bad)
    assert [r["papd"] for r in out.orderBy("Date").collect()] == [10, 15, 12]


def test_peaks_are_a_column(spark):
    sf = spark.createDataFrame([("1", at("7:00"), 0.5, 10), ("1", at("8:00"), 0.1, 30), ("1", at("12:00"), 0.9, 5)], "SignalID string, Date_Hour timestamp_ntz, sf_freq double, cycles int")
    out = M.split_failures_by_peak(sf).select("Peak", F.round("sf_freq", 6).alias("f"), "cycles")
    assert rows(out) == [("Off_Peak", 0.9, 5), ("Peak", 0.2, 40)]


@pytest.mark.parametrize("merge", [False, True])
@pytest.mark.parametrize("bin_seconds", [30, 3600, 86_400])
def test_the_sweep_equals_summing_overlaps(spark, merge, bin_seconds):
    draw = np.random.default_rng(5)
    seconds = lambda n: at("0:00") + timedelta(seconds=int(n))
    spans, dets = [], []
    for cycle in range(60):
        lo = int(draw.integers(0, 4000))
        spans += [("1", int(p), DAY, seconds(cycle), seconds(lo + 50 * k), seconds(lo + 50 * k + int(draw.integers(0, 40)))) for k in range(2) for p in (2, 4)]
    spans.append(("1", 9, DAY, seconds(1), seconds(10), seconds(20)))
    for _ in range(150):
        on = int(draw.integers(0, 4200))
        dets.append(("1", int(draw.choice([2, 4])), DAY, int(draw.integers(1, 4)), seconds(on), seconds(on + int(draw.choice([0, 3, 20, 4000])))))
    dets.append(("1", 2, DAY, 3, seconds(50), seconds(10)))
    want = []
    for phase, cycle in sorted({(s[1], s[3]) for s in spans}):
        mine, best = [s for s in spans if (s[1], s[3]) == (phase, cycle)], 0.0
        for det in (1, 2, 3):
            held = sorted((d[4], d[5]) for d in dets if d[1] == phase and d[3] == det and d[4] <= d[5])
            if merge:
                joined = []
                for on, off in held:
                    if joined and on <= joined[-1][1]:
                        joined[-1] = (joined[-1][0], max(off, joined[-1][1]))
                    else:
                        joined.append((on, off))
                held = joined
            total = sum(max(0.0, (min(off, s[5]) - max(on, s[4])).total_seconds()) for on, off in held for s in mine)
            longest = max([(s[5] - s[4]).total_seconds() for s in mine if any(on <= s[5] and off >= s[4] for on, off in held)], default=0)
            best = max(best, total / longest if longest else 0.0)
        want.append((phase, cycle, round(best, 6)))
    kinds = "SignalID string, Phase int, Date date, "
    intervals = spark.createDataFrame(spans, kinds + "CycleStart timestamp_ntz, IntervalStart timestamp_ntz, IntervalEnd timestamp_ntz")
    detections = spark.createDataFrame(dets, kinds + "Detector int, DetOn timestamp_ntz, DetOff timestamp_ntz")
    out = M.occupancy(detections, intervals, merge_spans=merge, bin_seconds=bin_seconds)
    assert [(p, c, round(o, 6)) for p, c, o in rows(out, "Phase", "CycleStart", "occ")] == want


def test_a_detector_that_stays_on_is_two_edges(spark):
    intervals = spark.createDataFrame([("1", 4, DAY, at("8:00"), at("8:00"), at("8:00:20"))], "SignalID string, Phase int, Date date, CycleStart timestamp_ntz, IntervalStart timestamp_ntz, IntervalEnd timestamp_ntz")
    stuck = spark.createDataFrame([("1", 4, DAY, 7, at("0:00"), at("23:59:59"))], "SignalID string, Phase int, Date date, Detector int, DetOn timestamp_ntz, DetOff timestamp_ntz")
    out = M.occupancy(stuck, intervals, bin_seconds=60)
    assert rows(out, "occ") == [(1.0,)]
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in text
